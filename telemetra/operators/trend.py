"""Degradation, remaining useful life, failure prediction and forecasts
(S14-S17, T1-T5).

All fits are least squares through ``regr_*`` aggregates per asset (and per
sensor where needed): partial aggregation, no arrays, nothing collected.
Positions x = 0..n-1 inside the fitted window come from the sequence
numbering, as the source fits against ``arange(len(window))``.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.functions.scoring import (failure_probability, failure_risk,
                                         recommendation)
from telemetra.operators import sequence as seq
from telemetra.operators.lastn import POS, last_n_rows
from telemetra.profile import DEGRADATION_WEIGHTS, SensorProfile

SLOPE_EPS = 1e-12  # slopes below this are float noise, treated as flat


def baseline_row(baseline: DataFrame) -> dict[str, tuple[float, float]]:
    """Small fitted baseline (one row per sensor: sensor, mean, std) as a dict.

    The baseline is a fitted model with one entry per sensor -- bounded in
    size -- so reading it back is a parameter hand-off, not a data collect.
    """
    return {r["sensor"]: (r["mean"], r["std"]) for r in
            baseline.select("sensor", "mean", "std").collect()}


def degradation_index(df: DataFrame, baseline: Mapping[str, tuple[float, float]],
                      roles: Mapping[str, str] | None = None,
                      weights: Mapping[str, float] = DEGRADATION_WEIGHTS,
                      reversed_roles: Sequence[str] = ("efficiency_pct",),
                      name: str = "degradation") -> DataFrame:
    """Weighted mean of clip(deviation / 5, 0, 1) over the degradation sensors.

    ``roles`` maps role names (weights' keys) to columns; the baseline is
    keyed by column.  Sensors without a column or baseline are skipped and
    the weights renormalised; a role outside ``weights`` gets 1/k.
    """
    roles = dict(roles or {k: k for k in weights})
    present = [(role, col) for role, col in roles.items() if col in df.columns and col in baseline]
    if not present:
        raise ValueError("no degradation sensor present")
    total, wsum = None, 0.0
    for role, col in present:
        m, sd = baseline[col]
        if role in reversed_roles:
            dev = (F.lit(m) - F.col(col)) / (F.lit(sd) + 1e-10)
        else:
            dev = (F.col(col) - F.lit(m)) / (F.lit(sd) + 1e-10)
        # a missing sensor makes the index missing, not zero
        score = F.when(dev.isNotNull(), F.least(F.greatest(dev / 5.0, F.lit(0.0)), F.lit(1.0)))
        w = weights.get(role, 1.0 / len(present))
        total = score * w if total is None else total + score * w
        wsum += w
    return df.withColumn(name, total / wsum)


def estimate_rul(df: DataFrame, profile: SensorProfile, value_col: str = "degradation",
                 window_days: int = 7, interval_minutes: int = 5,
                 failure_threshold: float = 0.7, group_cols: Sequence[str] = (),
                 rounded: bool = True) -> DataFrame:
    """T1 (and T2 with ``group_cols``): trend of the degradation index over
    the last ``window_days`` of samples; days until it reaches the threshold.

    slope > 0: (threshold - current) / slope samples (0 when already past);
    otherwise 365.  failure_probability = min(1, exp(3 d - 2)); confidence
    from R^2 = 1 - SSres / (SStot + 1e-10): >0.8 HIGH, >0.5 MEDIUM, else LOW.
    Fewer than 2 rows: rul null, probability 0; fewer than 2 non-null
    values: rul null, probability = current index.
    """
    per_day = (24 * 60) // interval_minutes
    window = window_days * per_day
    keys = [profile.asset, *group_cols]
    prof = profile.with_(asset="_grp") if group_cols else profile
    x = df.withColumn("_grp", F.concat_ws("\u0001", *[F.col(c).cast("string") for c in keys])) \
        if group_cols else df
    recent = last_n_rows(x, prof, window, keep_position=True)
    # regression slopes and R^2 do not depend on where the axis starts
    pos = -F.col(POS).cast("double")
    y = F.col(value_col)
    agg = recent.withColumn("_x", pos).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.regr_count(y, "_x").alias("_k"),
        F.regr_slope(y, "_x").alias("_slope"), F.regr_syy(y, "_x").alias("_syy"),
        F.regr_sxy(y, "_x").alias("_sxy"),
        F.max_by(y, "_x").alias("_cur"))
    slope, cur = F.col("_slope"), F.col("_cur")
    fit = (F.col("_n") >= 2) & (F.col("_k") >= 2)
    rul = (F.when(~fit, F.lit(None).cast("double"))
           .when(slope > SLOPE_EPS, F.when(F.lit(failure_threshold) - cur > 0,
                                           (F.lit(failure_threshold) - cur) / slope / per_day)
                 .otherwise(F.lit(0.0)))
           .otherwise(F.lit(365.0)))
    prob = (F.when(F.col("_n") < 2, F.lit(0.0)).when(F.col("_k") < 2, cur)
            .otherwise(failure_probability(cur)))
    ss_res = F.col("_syy") - slope * F.col("_sxy")
    r2 = F.when(fit, 1 - ss_res / (F.col("_syy") + 1e-10))
    conf = F.when(r2 > 0.8, "HIGH").when(r2 > 0.5, "MEDIUM").otherwise("LOW")
    out = agg.select(*keys, rul.alias("rul_days"), prob.alias("failure_probability"),
                     cur.alias("degradation_index"),
                     F.when(fit, slope * per_day).alias("degradation_rate_per_day"),
                     conf.alias("confidence"), r2.alias("r_squared"))
    out = out.withColumn("recommendation", F.when(
        F.col("rul_days").isNotNull(), recommendation("rul_days", "failure_probability")))
    if rounded:
        out = out.withColumns({
            "rul_days": F.round("rul_days", 1), "failure_probability": F.round("failure_probability", 4),
            "degradation_index": F.round("degradation_index", 4),
            "degradation_rate_per_day": F.round("degradation_rate_per_day", 6),
            "r_squared": F.round("r_squared", 4)})
    return out


def failure_prediction(df: DataFrame, profile: SensorProfile, vib_col: str, temp_col: str,
                       fault_col: str | None = None, vib_base: tuple[float, float] = (1.98, 0.49),
                       temp_base: tuple[float, float] = (499.0, 28.8), window_rows: int = 168 * 60,
                       min_rows: int = 12, samples_per_day: int = 288,
                       rounded: bool = True) -> DataFrame:
    """Endpoint failure model over the last ``window_rows`` rows per asset.

    d = min(1, 0.3 v + 0.3 t + 0.4 fault_ratio) with v, t the latest
    deviations from the fixed baselines floored at 0; days: d < 0.7 and
    vibration slope >= 0 -> (0.7 - d) / max(slope * 288, 0.001) clipped to
    0..365; d >= 0.7 -> (1 - d) * 10; else 180.  Assets with fewer than
    ``min_rows`` rows get ``sufficient_data = false`` and null predictions.
    """
    recent = last_n_rows(df, profile, window_rows, keep_position=True)
    pos = -F.col(POS).cast("double")
    fault = F.col(fault_col) if fault_col else profile.fault_col()
    agg = recent.withColumn("_x", pos).groupBy(profile.asset).agg(
        F.count(F.lit(1)).alias("_n"),
        F.regr_slope(F.col(vib_col), "_x").alias("_vs"),
        F.max_by(F.col(vib_col), "_x").alias("_v"),
        F.max_by(F.col(temp_col), "_x").alias("_t"),
        F.avg(fault.cast("double")).alias("_fr"))
    vdev = F.greatest(F.lit(0.0), (F.col("_v") - vib_base[0]) / vib_base[1])
    tdev = F.greatest(F.lit(0.0), (F.col("_t") - temp_base[0]) / temp_base[1])
    d = F.least(F.lit(1.0), vdev * 0.3 + tdev * 0.3 + F.col("_fr") * 0.4)
    x = agg.withColumn("_d", d)
    slope = F.coalesce(F.col("_vs"), F.lit(0.0))
    days = (F.when((F.col("_d") < 0.7) & (slope >= 0), F.least(F.lit(365.0), F.greatest(
        F.lit(0.0), (0.7 - F.col("_d")) / F.greatest(slope * samples_per_day, F.lit(0.001)))))
        .when(F.col("_d") >= 0.7, F.greatest(F.lit(0.0), (1.0 - F.col("_d")) * 10))
        .otherwise(F.lit(180.0)))
    ok = F.col("_n") >= min_rows
    p = failure_probability(F.col("_d"))
    out = x.select(profile.asset, ok.alias("sufficient_data"),
                   F.when(ok, p).alias("failure_probability"),
                   F.when(ok, days).alias("rul_days"), F.when(ok, F.col("_d")).alias("degradation_index"),
                   F.when(ok, slope).alias("degradation_rate"))
    out = out.withColumn("risk_level", F.when(F.col("sufficient_data"), failure_risk(
        "failure_probability", "rul_days"))).withColumn(
        "recommendation", F.when(F.col("sufficient_data"),
                                 recommendation("rul_days", mode="endpoint")))
    if rounded:
        out = out.withColumns({"failure_probability": F.round("failure_probability", 4),
                               "rul_days": F.round("rul_days", 1),
                               "degradation_index": F.round("degradation_index", 4),
                               "degradation_rate": F.round("degradation_rate", 6)})
    return out


def linear_forecast(df: DataFrame, profile: SensorProfile, sensors: Sequence[str] | None = None,
                    fit_rows: int = 12, steps: int = 12) -> DataFrame:
    """T4: fit the last ``fit_rows`` rows per asset and sensor (x = 0..k-1),
    extrapolate ``steps`` points (x = k..k+steps-1); a missing value counts
    as 0.  Output (asset, sensor, step, value); assets with < 2 rows give
    nothing."""
    sensors = list(sensors or profile.sensors)
    last = last_n_rows(df, profile, fit_rows, keep_position=True)
    pos = -F.col(POS).cast("double")  # the newest row is at -1, the first forecast at 0
    long_df = last.withColumn("_x", pos).select(
        profile.asset, "_x", *[F.coalesce(F.col(s).cast("double"), F.lit(0.0)).alias(s)
                               for s in sensors]).unpivot([profile.asset, "_x"], sensors,
                                                          "sensor", "_y")
    fit = long_df.groupBy(profile.asset, "sensor").agg(
        F.count(F.lit(1)).alias("_k"), F.regr_slope("_y", "_x").alias("_b"),
        F.regr_intercept("_y", "_x").alias("_a"))
    fit = fit.filter(F.col("_k") >= 2)
    out = fit.select(profile.asset, "sensor", "_k", "_a", "_b",
                     F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    return out.select(profile.asset, "sensor", "step",
                      (F.col("_a") + F.col("_b") * (F.col("step") - 1)).alias("value"))


def forecast_bands(forecast: DataFrame, as_of: Column | str, horizon_minutes: int = 60,
                   step_minutes: int = 5, pct: float = 0.03, keep_order: bool = False) -> DataFrame:
    """T5: bands of +-pct around each forecast value, timestamps every
    ``step_minutes`` after ``as_of``, ``horizon // step`` steps (capped by
    the steps available).  As in the source, a negative value gives a lower
    bound above the upper one unless ``keep_order``."""
    n = horizon_minutes // step_minutes
    as_of = F.col(as_of) if isinstance(as_of, str) else as_of
    lo, hi = F.col("value") * (1 - pct), F.col("value") * (1 + pct)
    if keep_order:
        lo, hi = F.least(lo, hi), F.greatest(lo, hi)
    out = forecast.filter(F.col("step") <= n)
    return out.select(*[c for c in forecast.columns if c != "value"],
                      (as_of.cast("timestamp") + F.make_interval(
                          mins=F.col("step") * step_minutes)).alias("forecast_ts"),
                      F.col("value"), lo.alias("lower_bound"), hi.alias("upper_bound"))


# ---------------------------------------------------------------------------
# Learned forecaster on lag windows (re-aimed to MLlib)
# ---------------------------------------------------------------------------

class ForecasterModel:
    """A fitted ``PipelineModel`` (scaler, then one regressor per (step, target) output) and its shape."""

    def __init__(self, pipeline, features, targets, seq_len, horizon):
        self.pipeline = pipeline
        self.features, self.targets = list(features), list(targets)
        self.seq_len, self.horizon = seq_len, horizon


def forecaster_windows(df: DataFrame, profile: SensorProfile, features: Sequence[str],
                       targets: Sequence[str], seq_len: int = 48, horizon: int = 12,
                       validation: float = 0.2) -> DataFrame:
    """W7/W8 as training data: ``raw`` (flattened lag vector), ``y0 ..`` (step-major, then target),
    ``split``, and ``last0 ..`` (each target's value at the end of the window, the naive forecast).
    Missing values count as 0, as in :func:`linear_forecast`."""
    from pyspark.ml.functions import array_to_vector

    from telemetra.operators.features import sequences, split_sequences

    inputs = [*features, *[t for t in targets if t not in features]]
    df = df.fillna(0.0, subset=inputs)
    seqs = split_sequences(sequences(df, profile, inputs, targets, seq_len, horizon), validation)
    n = len(features)
    lags = F.flatten(F.transform("x", lambda row: F.slice(row, 1, n)))
    return seqs.select(
        profile.asset, "seq_idx", "split", array_to_vector(lags).alias("raw"),
        *[F.col("y")[i].alias(f"y{i}") for i in range(horizon * len(targets))],
        *[F.col("x")[seq_len - 1][inputs.index(t)].alias(f"last{k}") for k, t in enumerate(targets)])


def train_forecaster(df: DataFrame, profile: SensorProfile, features: Sequence[str],
                     targets: Sequence[str], seq_len: int = 48, horizon: int = 12,
                     validation: float = 0.2, max_iter: int = 50, loss: str = "huber"
                     ) -> tuple[ForecasterModel, DataFrame]:
    """Sliding windows (W7) -> flattened lag vector -> MinMax scaling
    fitted on the chronological training part only (W8) -> one linear
    regressor per output (step-major, then target; Huber loss by default),
    as one ML ``Pipeline``.

    Returns the model and a metrics DataFrame (output, split, n, mae,
    naive_mae): the mean absolute error, and that of the window's last value
    as the forecast."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import MinMaxScaler
    from pyspark.ml.regression import LinearRegression

    data = forecaster_windows(df, profile, features, targets, seq_len, horizon, validation)
    n_out = horizon * len(targets)
    stages = [MinMaxScaler(inputCol="raw", outputCol="features")]
    stages += [LinearRegression(featuresCol="features", labelCol=f"y{i}", predictionCol=f"p{i}", loss=loss,
                                maxIter=max_iter, regParam=0.0 if loss == "squaredError" else 1e-4)
               for i in range(n_out)]
    fitted = Pipeline(stages=stages).fit(data.filter(F.col("split") == "train"))
    error = {f"e{i}": F.abs(F.col(f"p{i}") - F.col(f"y{i}")) for i in range(n_out)}
    naive = {f"v{i}": F.abs(F.col(f"last{i % len(targets)}") - F.col(f"y{i}")) for i in range(n_out)}
    sums = fitted.transform(data).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(e).alias(c) for c, e in {**error, **naive}.items()])
    metrics = sums.select("split", "n", F.inline(F.array(*[
        F.struct(F.lit(i).alias("output"), F.col(f"e{i}").alias("mae"), F.col(f"v{i}").alias("naive_mae"))
        for i in range(n_out)]))).select("output", "split", "n", "mae", "naive_mae")
    return ForecasterModel(fitted, features, targets, seq_len, horizon), metrics


def forecast(model: ForecasterModel, df: DataFrame, profile: SensorProfile) -> DataFrame:
    """The last ``seq_len`` rows of every asset -> ``horizon`` x targets
    forecasts rounded to 4; assets with fewer rows get no forecast and are
    listed with ``sufficient_data = false``."""
    from pyspark.ml.functions import array_to_vector

    last = last_n_rows(df, profile, model.seq_len, keep_position=True)
    feat = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in model.features])
    # windows of the last seq_len rows, in time order, per asset
    grouped = last.groupBy(profile.asset).agg(
        F.array_sort(F.collect_list(F.struct((-F.col(POS)).alias("rn"), feat.alias("f"))))
        .alias("_rows"), F.count(F.lit(1)).alias("_cnt"))  # <= seq_len rows per asset
    ok = F.col("_cnt") >= model.seq_len
    vec = grouped.withColumn("sufficient_data", ok).withColumn(
        "raw", F.when(ok, array_to_vector(F.flatten(F.transform("_rows", lambda r: r["f"])))))
    ready = model.pipeline.transform(vec.filter(F.col("sufficient_data")))
    n_targets = len(model.targets)
    out = ready.select(profile.asset, F.inline(F.array(*[
        F.struct(F.lit(i // n_targets + 1).alias("step"), F.lit(model.targets[i % n_targets]).alias("target"),
                 F.round(F.col(f"p{i}"), 4).alias("value"))
        for i in range(model.horizon * n_targets)])))
    short = vec.filter(~F.col("sufficient_data")).select(
        profile.asset, F.lit(None).cast("int").alias("step"), F.lit(None).cast("string").alias("target"),
        F.lit(None).cast("double").alias("value"))
    return out.withColumn("sufficient_data", F.lit(True)).unionByName(
        short.withColumn("sufficient_data", F.lit(False)))
