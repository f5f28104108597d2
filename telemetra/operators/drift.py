"""Data drift: KS test, PSI, mean shift, verdicts, history.

Inputs are long tables (feature, value) for the baseline and the current
window.  The KS statistic is the largest gap between the two empirical
distribution functions; running counts in value order come from
:func:`stats.value_running_counts` (offsets of digits), so no feature
is ever sorted in one task.  The p-value uses the asymptotic Kolmogorov
distribution (scipy may switch to an exact p for small samples).
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.operators.stats import baseline_stats, unpivot, value_running_counts

KS_TERMS = 5


def kolmogorov_sf(lam: Column, terms: int = KS_TERMS) -> Column:
    """Asymptotic Kolmogorov survival function Q(lambda), two regimes:

    lambda < 1.18: 1 - sqrt(2 pi) / lambda * sum_k exp(-(2k-1)^2 pi^2 / (8 lambda^2))
    otherwise:     2 * sum_k (-1)^(k-1) exp(-2 k^2 lambda^2)
    Each series converges to double precision within a few terms.
    """
    small = None
    big = None
    for k in range(1, terms + 1):
        a = F.exp(F.try_divide(F.lit(-((2 * k - 1) ** 2) * (math.pi ** 2)), 8.0 * lam * lam))
        b = ((-1) ** (k - 1)) * F.exp(-2.0 * k * k * lam * lam)
        small = a if small is None else small + a
        big = b if big is None else big + b
    q = (F.when(lam <= 0, F.lit(1.0))
         .when(lam < 1.18, 1.0 - F.try_divide(F.lit(math.sqrt(2 * math.pi)), lam) * small)
         .otherwise(2.0 * big))
    return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))


def drift_baseline(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per feature mean, std, median, p05, p95 and sample size (the
    sample itself stays a table, not a driver array)."""
    return baseline_stats(unpivot(df, features, var="feature", val="value"),
                          ["feature"], with_median=True)


def _per_value(base_long: DataFrame, cur_long: DataFrame, feature: str, value: str) -> DataFrame:
    """The one relation that every drift measure reads: ``feature, value, wb, wc`` (counts on either side)."""
    def side(rows: DataFrame, wb: int, wc: int) -> DataFrame:
        return rows.select(feature, value, F.lit(wb).alias("wb"), F.lit(wc).alias("wc"))

    return side(base_long, 1, 0).unionByName(side(cur_long, 0, 1)).filter(F.col(value).isNotNull()) \
        .groupBy(feature, value).agg(F.sum("wb").alias("wb"), F.sum("wc").alias("wc"))


def _totals(per_value: DataFrame, feature: str, value: str) -> DataFrame:
    """Per feature: counts, means and the joint range."""
    x = F.col(value)
    return per_value.groupBy(feature).agg(
        F.sum("wb").alias("nb"), F.sum("wc").alias("nc"), F.min(value).alias("_lo"), F.max(value).alias("_hi"),
        F.try_divide(F.sum(F.col("wb") * x), F.sum("wb")).alias("baseline_mean"),
        F.try_divide(F.sum(F.col("wc") * x), F.sum("wc")).alias("current_mean"))


def _ks(per_value: DataFrame, totals: DataFrame, feature: str, value: str) -> DataFrame:
    """KS statistic and p-value per feature of ``totals`` (one row per feature, so it is broadcast)."""
    gap = F.abs(F.try_divide(F.col("cum_wb"), F.col("nb")) - F.try_divide(F.col("cum_wc"), F.col("nc")))
    d = value_running_counts(per_value, [feature], value, ["wb", "wc"]) \
        .join(F.broadcast(totals.select(feature, "nb", "nc")), feature) \
        .groupBy(feature).agg(F.max(gap).alias("ks_statistic"), F.first("nb").alias("nb"), F.first("nc").alias("nc"))
    en = F.sqrt(F.col("nb") * F.col("nc") / (F.col("nb") + F.col("nc")))
    return d.select(feature, "ks_statistic", kolmogorov_sf(en * F.col("ks_statistic")).alias("p_value"),
                    F.col("nb").cast("long").alias("n_baseline"), F.col("nc").cast("long").alias("n_current"))


def _psi(per_value: DataFrame, totals: DataFrame, feature: str, value: str, bins: int, floor: float) -> DataFrame:
    """PSI and the baseline's squared deviations per feature, by one histogram."""
    span = F.col("_hi") - F.col("_lo")
    bucket = F.when(span > 0, F.least(F.floor(F.try_divide(F.col(value) - F.col("_lo"), span) * bins),
                                      F.lit(bins - 1))).cast("int")
    off = F.col(value) - F.col("baseline_mean")
    hist = per_value.join(F.broadcast(totals.select(feature, "nb", "nc", "_lo", "_hi", "baseline_mean")), feature) \
        .withColumn("_bin", bucket).groupBy(feature, "_bin").agg(
        F.sum("wb").alias("cb"), F.sum("wc").alias("cc"), F.first("nb").alias("nb"), F.first("nc").alias("nc"),
        F.sum(F.col("wb") * off * off).alias("_ss"))
    # bins with no rows on either side contribute floor-vs-floor = 0
    pb = F.greatest(F.try_divide(F.col("cb"), F.col("nb")), F.lit(floor))
    pc = F.greatest(F.try_divide(F.col("cc"), F.col("nc")), F.lit(floor))
    term = F.when(F.col("_bin").isNull(), F.lit(0.0)).otherwise((pc - pb) * F.log(pc / pb))
    return hist.groupBy(feature).agg(F.sum(term).alias("psi"), F.sum("_ss").alias("_ss"), F.first("nb").alias("_nb"))


def ks_test(base_long: DataFrame, cur_long: DataFrame, feature: str = "feature",
            value: str = "value") -> DataFrame:
    """Two-sample KS statistic and asymptotic p per feature."""
    per_value = _per_value(base_long, cur_long, feature, value)
    return _ks(per_value, _totals(per_value, feature, value), feature, value)


def psi(base_long: DataFrame, cur_long: DataFrame, bins: int = 10, feature: str = "feature",
        value: str = "value", floor: float = 1e-6) -> DataFrame:
    """Population stability index on ``bins`` equal bins over the joint
    range (last bin closed), shares floored at ``floor``; zero range -> 0."""
    per_value = _per_value(base_long, cur_long, feature, value)
    return _psi(per_value, _totals(per_value, feature, value), feature, value, bins, floor).select(feature, "psi")


def drift_report(base: DataFrame, cur: DataFrame, features: Sequence[str],
                 significance: float = 0.05, psi_limit: float = 0.2,
                 min_current: int = 10) -> DataFrame:
    """Per-feature KS, PSI, mean shift and verdict, plus the run-level
    totals (drift_count, total_features, drift_percentage, overall_status)
    repeated on every row.  Features with < ``min_current`` current values
    are skipped.

    Both tables are reduced once to counts per (feature, value); counts,
    moments, KS and PSI are all taken from that relation.
    """
    per_value = _per_value(unpivot(base, features, var="feature", val="value"),
                           unpivot(cur, features, var="feature", val="value"), "feature", "value")
    totals = _totals(per_value, "feature", "value").filter((F.col("nc") >= min_current) & (F.col("nb") > 0))
    shares = _psi(per_value, totals, "feature", "value", 10, 1e-6)
    rep = _ks(per_value, totals, "feature", "value").join(shares, "feature") \
        .join(totals.select("feature", "baseline_mean", "current_mean"), "feature")
    deviation = F.when(F.col("_nb") > 1, F.sqrt(F.col("_ss") / (F.col("_nb") - 1)))
    rep = rep.withColumn("mean_shift_sigma", F.abs(F.col("current_mean") - F.col("baseline_mean")) /
                         (deviation + 1e-10))
    rep = rep.withColumn("is_drifted", (F.col("p_value") < significance) | (F.col("psi") > psi_limit))
    # run totals beside every feature row: the report has one row per
    # feature (bounded by the feature list), so a global window is cheap
    allw = Window.partitionBy()
    rep = rep.drop("_ss", "_nb")
    rep = rep.withColumn("total_features", F.count(F.lit(1)).over(allw)) \
        .withColumn("drift_count", F.count_if("is_drifted").over(allw))
    return rep.withColumn("drift_percentage", F.round(
        F.col("drift_count") / F.greatest(F.col("total_features"), F.lit(1)) * 100, 1)) \
        .withColumn("overall_status", F.when(F.col("drift_count") > 0, "DRIFT_DETECTED")
                    .otherwise("STABLE"))


def drift_history_summary(history: DataFrame, ts: str = "checked_at",
                          status: str = "overall_status") -> DataFrame:
    """Totals over stored drift checks; NO_CHECKS_RUN when there are none."""
    agg = history.agg(F.count(F.lit(1)).alias("total_checks"), F.max(ts).alias("last_check"),
                      F.count_if(F.col(status) == "DRIFT_DETECTED").alias("drift_detected_count"),
                      F.max_by(F.col(status), F.col(ts)).alias("_latest"))
    return agg.select("total_checks", "last_check", "drift_detected_count",
                      F.when(F.col("total_checks") == 0, "NO_CHECKS_RUN")
                      .otherwise(F.col("_latest")).alias("latest_status"))
