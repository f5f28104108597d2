"""Statistics over sensors: exact quantiles, summaries, fault analysis,
correlation, tallies, baselines (A3-A14, J5).

Exact quantiles and value-ordered running counts work on the ordered bits of
doubles (:func:`telemetra.functions.ordered.with_ordered_bits`), cut into three
digits, so that no column and no group is ever ordered in one task, whatever
its size and however its values are spread:

* a quantile is a rank; one histogram per digit (combined on the map side)
  finds the interval that holds the rank, and only rows of such intervals go
  into the next digit's histogram,
* running counts add the offset of the high digits, of the middle digits
  inside them, and the running sum inside one combination of both.

A window sees at most 2**(bits of a digit) rows, or the ``GROUP_SORTED``
values of a small group, whose quantiles are read off one sort.  There is one plan at every
size, and no job is started while a query is built.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.functions.ordered import with_ordered_bits
from telemetra.operators.sequence import null_safe_join
from telemetra.profile import SensorProfile

#: Lowest bits cut off by the high and by the middle digits of a value.
HIGH, MIDDLE = 42, 21
#: Values of a group that one task orders.
GROUP_SORTED = 100_000


def unpivot(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str] = (),
            var: str = "sensor", val: str = "value") -> DataFrame:
    """Wide -> long (one row per id and column); NaN becomes null."""
    cols = list(cols)
    casted = df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in cols])
    long_df = casted.unpivot(list(id_cols), cols, var, val)
    return long_df.withColumn(val, F.nanvl(F.col(val), F.lit(None).cast("double")))


def _digits(df: DataFrame, value_col: str, names: Sequence[str] = ("_k1", "_k2", "_k3")) -> DataFrame:
    """Rows with digits of their value: ``_k1`` (high), ``_k2`` (high and middle), ``_k3`` (all)."""
    cut = {"_k1": F.shiftright("_bits", HIGH), "_k2": F.shiftright("_bits", MIDDLE), "_k3": F.col("_bits")}
    return with_ordered_bits(df, value_col, "_bits").withColumns({n: cut[n] for n in names}).drop("_bits")


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], few_groups: bool = False) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``percentile``).

    Returns (group..., p, q).  Null values are ignored, NaN counts as larger
    than all others; a null group is a group, one without values yields no
    rows.  Ranks are found digit by digit (see the module): the first
    histogram has at most 2**22 rows per group, and the others are taken over
    the intervals that hold a wanted rank only.  ``few_groups`` says that the
    are names of columns (a bounded set): the intervals are then
    broadcast and no row is shuffled.  Else only groups of more than
    ``GROUP_SORTED`` values go that way; the others, which a task can order
    one by one, are sorted once.
    """
    g = list(group_cols)
    x = df.filter(F.col(value_col).isNotNull()).select(*g, F.col(value_col).cast("double").alias("_v"))
    if not g or few_groups:
        return _quantiles_by_digits(x, g, probs, few_groups)
    large = F.broadcast(x.groupBy(*g).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > GROUP_SORTED).drop("_c"))
    ordered = _quantiles_by_sort(null_safe_join(x, large, g, "left_anti"), g, probs)
    return ordered.unionByName(_quantiles_by_digits(null_safe_join(x, large, g, "left_semi"), g, probs, few_groups))


def _ranks(probs: Sequence[float]) -> Column:
    """Per quantile its position among ``_n`` values, and the one or two ranks (from 0) around it."""
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("pos"))
                       for p in probs])
    return F.flatten(F.transform(wanted, lambda r: F.array_distinct(F.array(*[
        F.struct(r["p"].alias("p"), r["pos"].alias("pos"), k(r["pos"]).cast("long").alias("k")) for k in (F.floor, F.ceil)]))))


def _between() -> Column:
    """Value at ``_pos`` between ``_lo`` and ``_hi``, those of the ranks around it."""
    part = F.col("_pos") - F.floor("_pos")
    return F.when((part == 0) | (F.col("_lo") == F.col("_hi")), F.col("_lo")).otherwise(
        F.col("_lo") + (F.col("_hi") - F.col("_lo")) * part)


def _quantiles_by_sort(x: DataFrame, g: list[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles of groups that a task can order: one shuffle and one sort."""
    whole = Window.partitionBy(*g)
    placed = x.withColumn("_at", F.row_number().over(whole.orderBy("_v")) - 1) \
        .withColumn("_n", F.count(F.lit(1)).over(whole.orderBy("_v").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)))
    near = F.lit(False)  # most rows are next to no quantile
    for p in probs:
        near = near | (F.abs(F.lit(float(p)) * (F.col("_n") - 1) - F.col("_at")) < 1)
    hits = placed.filter(near).withColumn("_r", F.explode(F.filter(_ranks(probs), lambda r: r["k"] == F.col("_at"))))
    return hits.groupBy(*g, F.col("_r.p").alias("p"), F.col("_r.pos").alias("_pos")).agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).select(*g, "p", _between().alias("q"))


def _quantiles_by_digits(x: DataFrame, g: list[str], probs: Sequence[float], few_groups: bool) -> DataFrame:
    """Quantiles of groups of any size, by histograms of the digits."""
    x = _digits(x, "_v", ["_k1"])

    def placed(hist: DataFrame, inside: list[str], by: str) -> DataFrame:
        """Histogram rows with the ranks they begin and end at inside ``inside``."""
        ordered = Window.partitionBy(*inside).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
        return hist.withColumn("_end", F.sum("_c").over(ordered)) \
            .withColumn("_start", F.col("_end") - F.col("_c"))

    whole = Window.partitionBy(*g)
    first = placed(x.groupBy(*g, "_k1").agg(F.count(F.lit(1)).alias("_c")), g, "_k1") \
        .withColumn("_n", F.sum("_c").over(whole))
    hits = first.withColumn("_r", F.explode(F.filter(
        _ranks(probs), lambda r: (r["k"] >= F.col("_start")) & (r["k"] < F.col("_end"))))) \
        .select(*g, "_k1", F.col("_r.p").alias("p"), F.col("_r.pos").alias("_pos"),
                (F.col("_r.k") - F.col("_start")).alias("_k"))
    for above, digit in (("_k1", "_k2"), ("_k2", "_k3")):
        intervals = hits.select(*g, above).distinct()
        x = _digits(null_safe_join(x, F.broadcast(intervals) if few_groups else intervals, [*g, above]), "_v", [digit])
        hist = placed(x.groupBy(*g, above, digit).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_v")),
                      [*g, above], digit)
        hits = null_safe_join(hist, hits.select(*g, above, "p", "_pos", "_k"), [*g, above]) \
            .filter((F.col("_k") >= F.col("_start")) & (F.col("_k") < F.col("_end"))) \
            .select(*g, digit, "p", "_pos", (F.col("_k") - F.col("_start")).alias("_k"), "_v")
    # a whole position has one rank, another one the two around it
    found = hits.groupBy(*g, "p", "_pos").agg(F.min("_k3").alias("_k3"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    return found.select(*g, "p", _between().alias("q"))


def value_running_counts(df: DataFrame, group_cols: Sequence[str], value_col: str,
                         weight_cols: Sequence[str], carry_cols: Sequence[str] = ()) -> DataFrame:
    """Running sums of ``weight_cols`` in ascending value order per group.

    Returns (group..., value, weights and ``carry_cols`` summed per value,
    ``cum_<w>`` running totals of the weights including the value); null
    values are left out, a null group is a group.  Values are first reduced
    per (group, value); totals of the middle and the high digits give the
    offsets of the sums inside one combination.
    """
    g, ws = list(group_cols), list(weight_cols)
    own = [*ws, *carry_cols]
    summed = df.filter(F.col(value_col).isNotNull()).groupBy(*g, value_col).agg(*[F.sum(c).alias(c) for c in own])
    per_value = _digits(summed, value_col)
    upto = (Window.unboundedPreceding, 0)
    before = (Window.unboundedPreceding, -1)

    def exclusive(total: DataFrame, inside: list[str], by: str, prefix: str) -> DataFrame:
        window = Window.partitionBy(*inside).orderBy(by).rowsBetween(*before)
        return total.select(*inside, by, *[F.coalesce(F.sum(c).over(window), F.lit(0)).alias(f"{prefix}{c}") for c in ws])

    middle = per_value.groupBy(*g, "_k1", "_k2").agg(*[F.sum(c).alias(c) for c in ws])
    high = exclusive(middle.groupBy(*g, "_k1").agg(*[F.sum(c).alias(c) for c in ws]), g, "_k1", "_h_")
    offsets = null_safe_join(exclusive(middle, [*g, "_k1"], "_k2", "_m_"), high, [*g, "_k1"]).drop("_k1")
    low = Window.partitionBy(*g, "_k2").orderBy("_k3").rowsBetween(*upto)
    running = per_value.select(*g, value_col, "_k2", *own, *[F.sum(c).over(low).alias(f"_l_{c}") for c in ws])
    return null_safe_join(running, offsets, [*g, "_k2"]).select(
        *g, value_col, *own, *[(F.col(f"_h_{c}") + F.col(f"_m_{c}") + F.col(f"_l_{c}")).alias(f"cum_{c}") for c in ws])


def summary_stats(long_df: DataFrame, group_cols: Sequence[str] = ("sensor",),
                  value_col: str = "value", decimals: int | None = 4) -> DataFrame:
    """Mean, std (ddof 1), min, max, p25/p50/p75 (linear), count."""
    g = list(group_cols)
    base = long_df.groupBy(*g).agg(
        F.avg(value_col).alias("mean"), F.stddev_samp(value_col).alias("std"),
        F.min(value_col).alias("min"), F.max(value_col).alias("max"),
        F.count(value_col).alias("count"))
    q = exact_quantiles(long_df, g, value_col, [0.25, 0.5, 0.75], few_groups=g == ["sensor"])
    qw = q.groupBy(*g).agg(*[
        F.max(F.when(F.col("p") == p, F.col("q"))).alias(name)
        for p, name in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]])
    out = base.join(qw, on=g, how="left")
    cols = ["mean", "std", "min", "max", "p25", "p50", "p75"]
    if decimals is not None:
        out = out.withColumns({c: F.round(c, decimals) for c in cols})
    return out.select(*g, *cols, F.col("count").cast("long").alias("count"))


def fault_analysis(df: DataFrame, sensors: Sequence[str], fault_col: str = "fault",
                   group_cols: Sequence[str] = (), health_col: str | None = None,
                   decimals: int = 4) -> tuple[DataFrame, DataFrame]:
    """Per-sensor fault/normal means, z difference and significance.

    Returns (ranking, overview).  ranking: group..., sensor, fault_mean,
    normal_mean, z_difference, significant, rank (1 = largest).  Empty side
    -> mean 0; at most one normal row -> std 1; z uses max(std, 0.001).
    overview: group..., total_rows, fault_count, normal_count, fault_rate,
    avg_health_during_fault, avg_health_during_normal.
    """
    g = list(group_cols)
    f = F.col(fault_col) == 1
    nrm = F.col(fault_col) == 0
    longf = unpivot(df, sensors, id_cols=[*g, fault_col], var="sensor", val="value")
    per = longf.groupBy(*g, "sensor").agg(
        F.avg(F.when(f, F.col("value"))).alias("_fm"),
        F.count(F.when(f, F.lit(1))).alias("_fc"),
        F.avg(F.when(nrm, F.col("value"))).alias("_nm"),
        F.count(F.when(nrm, F.lit(1))).alias("_nc"),
        F.stddev_samp(F.when(nrm, F.col("value"))).alias("_ns"))
    fm = F.when(F.col("_fc") > 0, F.col("_fm")).otherwise(F.lit(0.0))
    nm = F.when(F.col("_nc") > 0, F.col("_nm")).otherwise(F.lit(0.0))
    ns = F.when(F.col("_nc") > 1, F.col("_ns")).otherwise(F.lit(1.0))
    z = F.abs(fm - nm) / F.greatest(ns, F.lit(0.001))
    ranked = per.select(*g, "sensor", fm.alias("fault_mean"), nm.alias("normal_mean"),
                        z.alias("z_difference"))
    w = (Window.partitionBy(*g) if g else Window.partitionBy()).orderBy(
        F.col("z_difference").desc(), F.col("sensor"))
    ranking = ranked.select(
        *g, "sensor", F.round("fault_mean", decimals).alias("fault_mean"),
        F.round("normal_mean", decimals).alias("normal_mean"),
        F.round("z_difference", decimals).alias("z_difference"),
        (F.col("z_difference") > 1.5).alias("significant"),
        F.row_number().over(w).alias("rank"))
    aggs = [F.count(F.lit(1)).alias("total_rows"),
            F.count(F.when(f, 1)).alias("fault_count"),
            F.count(F.when(~f | F.col(fault_col).isNull(), 1)).alias("normal_count")]
    if health_col:
        aggs += [F.round(F.avg(F.when(f, F.col(health_col))), 2).alias("avg_health_during_fault"),
                 F.round(F.avg(F.when(nrm, F.col(health_col))), 2).alias("avg_health_during_normal")]
    ov = (df.groupBy(*g) if g else df.groupBy()).agg(*aggs)
    ov = ov.withColumn("fault_rate", F.round(
        F.col("fault_count") / F.greatest(F.col("total_rows"), F.lit(1)), decimals))
    return ranking, ov


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over pairwise-complete rows; null when a side is constant
    (``corr`` raises on a zero variance under ANSI mode)."""
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def correlation_label(r: Column) -> Column:
    """Label for a Pearson r; null when r is undefined."""
    return (F.when(r.isNull(), F.lit(None).cast("string"))
            .when(r > 0.7, "strong positive").when(r > 0.3, "moderate positive")
            .when(r > -0.3, "weak/no").when(r > -0.7, "moderate negative")
            .otherwise("strong negative"))


def sensor_correlation(df: DataFrame, pairs: Sequence[tuple[str, str]],
                       group_cols: Sequence[str] = (), decimals: int | None = 4) -> DataFrame:
    """Pearson r for many column pairs in one aggregation pass.

    Output rows: group..., sensor_a, sensor_b, pearson_r (0 when undefined,
    as reported by the source), interpretation (null when undefined),
    data_points (non-null count of sensor_a).
    """
    g = list(group_cols)
    aggs = []
    for i, (a, b) in enumerate(pairs):
        aggs += [pearson(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_r{i}"),
                 F.count(a).alias(f"_n{i}")]
    wide = (df.groupBy(*g) if g else df.groupBy()).agg(*aggs)
    rows = [F.struct(F.lit(a).alias("sensor_a"), F.lit(b).alias("sensor_b"),
                     F.nanvl(F.col(f"_r{i}"), F.lit(None).cast("double")).alias("r"),
                     F.col(f"_n{i}").alias("data_points"))
            for i, (a, b) in enumerate(pairs)]
    long_df = wide.select(*g, F.explode(F.array(*rows)).alias("_x")).select(*g, "_x.*")
    rr = F.col("r") if decimals is None else F.round("r", decimals)
    return long_df.select(
        *g, "sensor_a", "sensor_b",
        F.coalesce(rr, F.lit(0.0)).alias("pearson_r"),
        correlation_label(F.col("r")).alias("interpretation"),
        F.col("data_points").cast("long").alias("data_points"))


def tag_counts(df: DataFrame, col: str, sep: str = ";") -> DataFrame:
    """Split on ``sep``, trim, drop empties, count per value."""
    items = F.filter(F.transform(F.split(F.col(col), _regex_quote(sep)), lambda s: F.trim(s)),
                     lambda s: s != "")
    return (df.select(F.explode(items).alias("tag")).groupBy("tag")
            .agg(F.count(F.lit(1)).alias("count")))


def tags_per_row(df: DataFrame, col: str, sep: str = ";") -> DataFrame:
    """Distribution of the number of selections per row (non-empty rows)."""
    items = F.filter(F.transform(F.split(F.col(col), _regex_quote(sep)), lambda s: F.trim(s)),
                     lambda s: s != "")
    return (df.filter(F.col(col).isNotNull() & (F.col(col) != ""))
            .select(F.size(items).alias("selections")).groupBy("selections")
            .agg(F.count(F.lit(1)).alias("rows")))


def _regex_quote(sep: str) -> str:
    import re
    return re.escape(sep)


def baseline_stats(long_df: DataFrame, group_cols: Sequence[str] = ("sensor",),
                   value_col: str = "value", with_median: bool = False,
                   min_rows: int = 0) -> DataFrame:
    """Mean, std (ddof 1), p05, p95 (and median), sample size.

    ``min_rows``: groups with fewer input rows (nulls included) are skipped.
    """
    g = list(group_cols)
    base = long_df.groupBy(*g).agg(
        F.avg(value_col).alias("mean"), F.stddev_samp(value_col).alias("std"),
        F.count(value_col).alias("n"), F.count(F.lit(1)).alias("_rows"))
    base = base.filter(F.col("_rows") >= min_rows).drop("_rows")
    probs = [0.05, 0.95] + ([0.5] if with_median else [])
    q = exact_quantiles(long_df, g, value_col, probs, few_groups=g in (["sensor"], ["feature"]))
    names = {0.05: "p05", 0.95: "p95", 0.5: "median"}
    qw = q.groupBy(*g).agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(names[p])
                            for p in probs])
    return base.join(qw, on=g, how="left")


def calibrate(df: DataFrame, sensors: Sequence[str], min_rows: int = 100,
              group_cols: Sequence[str] = ()) -> DataFrame:
    """Baseline of the rows given (normal rows); nothing under ``min_rows``."""
    longf = unpivot(df, sensors, id_cols=list(group_cols), var="sensor", val="value")
    return baseline_stats(longf, [*group_cols, "sensor"], min_rows=min_rows)


def quality_profile(df: DataFrame, profile: SensorProfile,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """A3: one pass -- total rows, nulls per column, duplicate keys, assets, time range.

    Returns one row per column (column, null_count) joined with the table
    totals so the result stays flat.
    """
    cols = list(columns or df.columns)
    key = F.struct(F.col(profile.asset), F.col(profile.ts))
    aggs = [F.count(F.lit(1)).alias("total_rows"),
            F.count_distinct(key).alias("_distinct_keys"),
            F.count_distinct(F.col(profile.asset)).alias("assets"),
            F.min(profile.ts).alias("first_ts"), F.max(profile.ts).alias("last_ts")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                        F.col(f"_null_{i}").alias("null_count"))
                               for i, c in enumerate(cols)]))
    return one.select("total_rows", (F.col("total_rows") - F.col("_distinct_keys")).alias(
        "duplicate_count"), "assets", "first_ts", "last_ts", rows.alias("_r")).select(
        "total_rows", "duplicate_count", "assets", "first_ts", "last_ts", "_r.column",
        F.col("_r.null_count").cast("long").alias("null_count"))


def feature_report(df: DataFrame, profile: SensorProfile, anomaly_col: str = "is_anomaly",
                   label_col: str | None = None) -> DataFrame:
    """A4/A5: rows, feature columns, assets, time range, anomaly rate %,
    positive-label ratio %."""
    aggs = [F.count(F.lit(1)).alias("total_records"),
            F.count_distinct(profile.asset).alias("assets"),
            F.min(profile.ts).alias("first_ts"), F.max(profile.ts).alias("last_ts"),
            F.round(F.avg(F.col(anomaly_col).cast("double")) * 100, 2).alias("anomaly_rate_pct")]
    if label_col:
        aggs.append(F.round(F.avg(F.col(label_col).cast("double")) * 100, 1).alias(
            "positive_ratio_pct"))
    return df.agg(*aggs).withColumn("total_features", F.lit(len(df.columns)))


def largest_asset(df: DataFrame, profile: SensorProfile) -> DataFrame:
    """Asset with the most rows (ties -> smallest asset id)."""
    counts = df.groupBy(profile.asset).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.col("rows").desc(), F.col(profile.asset).asc()).limit(1)
