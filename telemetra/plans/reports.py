"""Analytic report bundles (P1-P7) as DataFrame operators.

Each report is a fixed bundle of operators plus a risk rule; results are
rows with metrics and ``risk_level`` (no prose rendering).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra.operators import lastn as LN
from telemetra.operators import stats as ST
from telemetra.profile import SensorProfile


def _with_fault(df: DataFrame, profile: SensorProfile) -> DataFrame:
    return df.withColumn("fault", profile.fault_col())


def health_report(df: DataFrame, profile: SensorProfile, health_col: str = "health_score",
                  last_n: int = 100) -> DataFrame:
    """Health assessment over the last ``last_n`` rows per asset.

    avg >= 85 and fault rate < 0.1 LOW; >= 65 and < 0.3 MEDIUM; >= 40 HIGH;
    else CRITICAL.  Status HEALTHY / DEGRADED / AT RISK / CRITICAL; the three
    sensors deviating most during faults (A7 ranking)."""
    a = profile.asset
    last = _with_fault(LN.last_n_rows(df, profile, last_n), profile)
    st = last.groupBy(a).agg(F.round(F.avg(health_col), 4).alias("_avg"),
                             F.round(F.min(health_col), 4).alias("_min"),
                             F.count(F.lit(1)).alias("_n"),
                             F.count_if(F.col("fault") == 1).alias("fault_count"))
    st = st.withColumn("fault_rate", F.round(F.col("fault_count") / F.greatest("_n", F.lit(1)), 4))
    ranking, _ = ST.fault_analysis(last, profile.sensors, "fault", group_cols=[a])
    top = ranking.filter(F.col("rank") <= 3).groupBy(a).agg(*[
        F.max(F.when(F.col("rank") == k, F.col("sensor"))).alias(f"top_sensor_{k}")
        for k in (1, 2, 3)])
    avg, fr = F.col("_avg"), F.col("fault_rate")
    risk = (F.when((avg >= 85) & (fr < 0.1), "LOW").when((avg >= 65) & (fr < 0.3), "MEDIUM")
            .when(avg >= 40, "HIGH").otherwise("CRITICAL"))
    status = (F.when(risk == "LOW", "HEALTHY").when(risk == "MEDIUM", "DEGRADED")
              .when(risk == "HIGH", "AT RISK").otherwise("CRITICAL"))
    return st.join(top, a, "left").select(
        a, F.round(avg, 1).alias("avg_health"), F.round("_min", 1).alias("min_health"),
        fr.alias("fault_rate"), F.col("fault_count").cast("long").alias("fault_count"),
        risk.alias("risk_level"), status.alias("status"), "top_sensor_1", "top_sensor_2",
        "top_sensor_3")


def anomaly_window(df: DataFrame, profile: SensorProfile, sensors: Sequence[str],
                   baselines: Mapping[str, tuple[float, float]], z_threshold: float = 2.5,
                   last_n: int = 100) -> DataFrame:
    """Per asset and sensor over the last ``last_n`` rows: rows whose
    baseline |z| exceeds the threshold; rate over the requested n (source
    behaviour) and over the rows actually present.  Unknown baseline: mean
    0, std 1."""
    a = profile.asset
    last = LN.last_n_rows(df, profile, last_n)
    long_df = ST.unpivot(last, sensors, id_cols=[a], var="sensor", val="value")
    mean = F.coalesce(*[F.when(F.col("sensor") == s, F.lit(float(baselines[s][0])))
                        for s in sensors if s in baselines], F.lit(0.0))
    std = F.coalesce(*[F.when(F.col("sensor") == s, F.lit(float(baselines[s][1])))
                       for s in sensors if s in baselines], F.lit(1.0))
    z = F.abs((F.col("value") - mean) / std)
    out = long_df.groupBy(a, "sensor").agg(F.count_if(z > z_threshold).alias("total_anomalies"),
                                          F.count(F.lit(1)).alias("rows_present"))
    return out.select(a, "sensor", F.col("total_anomalies").cast("long"),
                      F.round(F.col("total_anomalies") / max(last_n, 1), 4).alias("anomaly_rate"),
                      F.round(F.col("total_anomalies") / F.col("rows_present"), 4).alias(
                          "anomaly_rate_actual"), F.col("rows_present").cast("long"))


def anomaly_report(df: DataFrame, profile: SensorProfile, sensors: Sequence[str],
                   baselines: Mapping[str, tuple[float, float]], last_n: int = 200) -> DataFrame:
    """S11 per sensor, ranked by rate; risk from the largest rate
    (>0.3 CRITICAL, >0.15 HIGH, >0.05 MEDIUM, else LOW)."""
    a = profile.asset
    win = anomaly_window(df, profile, sensors, baselines, last_n=last_n)
    w = Window.partitionBy(a)
    mx = F.max("anomaly_rate").over(w)
    risk = (F.when(mx > 0.3, "CRITICAL").when(mx > 0.15, "HIGH").when(mx > 0.05, "MEDIUM")
            .otherwise("LOW"))
    return win.select(a, "sensor", "total_anomalies", "anomaly_rate",
                      F.row_number().over(w.orderBy(F.col("anomaly_rate").desc(), "sensor"))
                      .alias("rank"), risk.alias("risk_level"))


def root_cause_report(df: DataFrame, profile: SensorProfile, sensors: Sequence[str]) -> DataFrame:
    """A7 deviation ranking joined with each sensor's correlation with
    the fault flag (ranked by |r|); risk by fault rate (>0.2 HIGH, >0.1
    MEDIUM, else LOW)."""
    a = profile.asset
    x = _with_fault(df, profile)
    ranking, ov = ST.fault_analysis(x, sensors, "fault", group_cols=[a])
    corr = ST.sensor_correlation(x, [(s, "fault") for s in sensors], group_cols=[a], decimals=None)
    corr = corr.select(a, F.col("sensor_a").alias("sensor"), "pearson_r", "interpretation")
    w = Window.partitionBy(a).orderBy(F.abs("pearson_r").desc(), "sensor")
    corr = corr.withColumn("corr_rank", F.row_number().over(w))
    fr = F.col("fault_rate")
    risk = F.when(fr > 0.2, "HIGH").when(fr > 0.1, "MEDIUM").otherwise("LOW")
    return ranking.join(corr, [a, "sensor"]).join(ov.select(a, "fault_rate"), a).select(
        a, "sensor", "z_difference", "significant", "rank", "pearson_r", "interpretation",
        "corr_rank", "fault_rate", risk.alias("risk_level"))


def correlation_report(df: DataFrame, pairs: Sequence[tuple[str, str]],
                       group_cols: Sequence[str] = ()) -> DataFrame:
    """Pairs ranked by |r|; ``strong`` when |r| > 0.5; risk LOW."""
    g = list(group_cols)
    c = ST.sensor_correlation(df, pairs, group_cols=g, decimals=None)
    w = (Window.partitionBy(*g) if g else Window.partitionBy()).orderBy(
        F.abs("pearson_r").desc(), "sensor_a", "sensor_b")
    return c.select(*g, "sensor_a", "sensor_b", "pearson_r", "interpretation",
                    (F.abs("pearson_r") > 0.5).alias("strong"), F.row_number().over(w).alias("rank"),
                    F.lit("LOW").alias("risk_level"))


def sensor_report(df: DataFrame, profile: SensorProfile,
                  limits: Mapping[str, tuple[float, float, str]], last_n: int = 50) -> DataFrame:
    """P5: statistics over the last ``last_n`` rows per asset and sensor;
    max above warn -> warning, above crit -> critical (high-side limits
    only, as in the source); risk HIGH if any critical, MEDIUM if any
    warning, else LOW."""
    a = profile.asset
    sensors = [s for s in profile.sensors]
    last = LN.last_n_rows(df, profile, last_n)
    stats = ST.summary_stats(ST.unpivot(last, sensors, id_cols=[a]), [a, "sensor"])
    warn = F.coalesce(*[F.when(F.col("sensor") == s, F.lit(float(w)))
                        for s, (w, c, d) in limits.items() if d == "high"], F.lit(None))
    crit = F.coalesce(*[F.when(F.col("sensor") == s, F.lit(float(c)))
                        for s, (w, c, d) in limits.items() if d == "high"], F.lit(None))
    x = stats.withColumn("above_warning", F.coalesce(F.col("max") > warn, F.lit(False))) \
        .withColumn("above_critical", F.coalesce(F.col("max") > crit, F.lit(False)))
    w = Window.partitionBy(a)
    risk = (F.when(F.max(F.col("above_critical").cast("int")).over(w) == 1, "HIGH")
            .when(F.max(F.col("above_warning").cast("int")).over(w) == 1, "MEDIUM")
            .otherwise("LOW"))
    return x.withColumn("risk_level", risk)


def diagnose_trigger(df: DataFrame, fault_col: str = "fault", anomaly_col: str = "anomaly_score",
                     health_col: str = "health_score") -> DataFrame:
    """Rows that trigger an automatic diagnosis: fault, anomaly >= 0.6
    or health <= 60.  Type FAULT / ANOMALY / DEGRADED; risk CRITICAL for a
    fault else HIGH.  Works on batch and streaming frames alike."""
    fault = F.coalesce(F.col(fault_col).cast("int"), F.lit(0)) == 1
    anom = F.coalesce(F.col(anomaly_col), F.lit(0.0))
    health = F.coalesce(F.col(health_col), F.lit(100.0))
    trig = df.filter(fault | (anom >= 0.6) | (health <= 60))
    return trig.withColumn("alert_type", F.when(fault, "FAULT").when(anom >= 0.6, "ANOMALY")
                           .otherwise("DEGRADED")) \
        .withColumn("risk_level", F.when(fault, "CRITICAL").otherwise("HIGH"))


def _gate(tier, gate, value, limit, kind):
    return F.struct(F.lit(tier).alias("tier"), F.lit(gate).alias("gate"),
                    value.cast("double").alias("value"), F.lit(float(limit)).alias("limit"),
                    F.lit(kind).alias("kind"))


GATE_LIMITS = {"max_null_percentage": 5.0, "max_duplicate_percentage": 1.0,
               "min_records_per_run": 100, "max_anomaly_rate": 15.0, "required_features_count": 50,
               "min_turbines": 1, "health_score_range": (0.0, 100.0),
               "required_tables": ("gold_turbine_hourly_kpis", "gold_turbine_latest_status",
                                   "gold_alert_history")}


def _judged(row: DataFrame, gates: list[Column]) -> DataFrame:
    """Gate rows of a tier's one-row aggregate."""
    kept = F.when(F.col("kind") == "max", F.col("value") <= F.col("limit")).otherwise(F.col("value") >= F.col("limit"))
    return row.select(F.explode(F.array(*gates)).alias("g")).select("g.*").withColumn("passed", kept).drop("kind")


def bronze_gates(raw: DataFrame, profile: SensorProfile, config: Mapping | None = None) -> DataFrame:
    """P7, raw tier: null % <= 5, duplicate % <= 1, rows >= 100; one aggregation."""
    cfg = GATE_LIMITS | dict(config or {})
    nulls = sum((F.count_if(F.col(c).isNull()) for c in raw.columns), F.lit(0))
    rows = F.greatest(F.col("n"), F.lit(1))
    r = raw.agg(F.count(F.lit(1)).alias("n"), nulls.alias("nulls"),
                F.count_distinct(F.struct(F.col(profile.asset), F.col(profile.ts))).alias("keys"))
    return _judged(r, [
        _gate("bronze", "null_percentage", F.col("nulls") * 100.0 / F.greatest(F.col("n") * len(raw.columns), F.lit(1)),
              cfg["max_null_percentage"], "max"),
        _gate("bronze", "duplicate_percentage", (F.col("n") - F.col("keys")) * 100.0 / rows,
              cfg["max_duplicate_percentage"], "max"),
        _gate("bronze", "records", F.col("n"), cfg["min_records_per_run"], "min")])


def silver_gates(features: DataFrame, profile: SensorProfile, config: Mapping | None = None) -> DataFrame:
    """P7, feature tier: anomaly rate <= 15 %, feature columns >= 50, sensor values within limits."""
    cfg = GATE_LIMITS | dict(config or {})
    ok = F.lit(True)
    for sensor, (lo, hi) in profile.limits.items():
        if sensor in features.columns:
            ok = ok & F.coalesce(F.col(sensor).between(lo, hi), F.lit(True))
    s = features.agg(F.avg(F.col("is_anomaly").cast("double")).alias("ar"), F.count_if(~ok).alias("out_of_range"))
    return _judged(s, [
        _gate("silver", "anomaly_rate", F.coalesce(F.col("ar"), F.lit(0.0)) * 100, cfg["max_anomaly_rate"], "max"),
        _gate("silver", "feature_count", F.lit(len(features.columns)), cfg["required_features_count"], "min"),
        _gate("silver", "out_of_range_rows", F.col("out_of_range"), 0.0, "max")])


def gold_gates(kpis: DataFrame, profile: SensorProfile, present_tables: Sequence[str] = (),
               config: Mapping | None = None) -> DataFrame:
    """P7, KPI tier: assets >= 1, health within 0..100, required tables present."""
    cfg = GATE_LIMITS | dict(config or {})
    lo, hi = cfg["health_score_range"]
    k = kpis.agg(F.count_distinct(profile.asset).alias("assets"),
                 F.count_if((F.col("health_score") < lo) | (F.col("health_score") > hi)).alias("bad_health"))
    missing = len(set(cfg["required_tables"]) - set(present_tables))
    return _judged(k, [_gate("gold", "assets", F.col("assets"), cfg["min_turbines"], "min"),
                       _gate("gold", "health_out_of_range", F.col("bad_health"), 0.0, "max"),
                       _gate("gold", "missing_tables", F.lit(missing), 0.0, "max")])


def quality_gates(raw: DataFrame, features: DataFrame, kpis: DataFrame, profile: SensorProfile,
                  present_tables: Sequence[str] = (), config: Mapping | None = None) -> DataFrame:
    """Gate rows (tier, gate, value, limit, passed) of all tiers, one aggregation per tier."""
    return bronze_gates(raw, profile, config).unionByName(silver_gates(features, profile, config)) \
        .unionByName(gold_gates(kpis, profile, present_tables, config))
