"""Hourly KPIs, health scoring, latest status, alarm history."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.functions.scoring import health_columns
from telemetra.profile import SensorProfile

# derived columns averaged into the KPI table when present: source -> output
KPI_DERIVED = {
    "pressure_ratio": "avg_pressure_ratio",
    "heat_rate": "avg_heat_rate",
    "efficiency_pct": "avg_efficiency",
    "specific_fuel_consumption": "avg_sfc",
    "temp_differential": "avg_temp_differential",
}


def time_bucket(ts: str, grain: str = "hour") -> Column:
    """date_trunc that keeps the input's timestamp flavour (NTZ stays NTZ)."""
    return F.date_trunc(grain, F.col(ts)).cast("timestamp_ntz")


def hourly_kpis(df: DataFrame, profile: SensorProfile, grain: str = "hour",
                sensors: Sequence[str] | None = None,
                derived: Mapping[str, str] | None = None,
                bucket_col: str = "hour_bucket") -> DataFrame:
    """A1: per asset and time bucket: avg/min/max/stddev per sensor,
    reading_count, anomaly_count, avg_anomaly_score and averages of the
    derived columns present.  One hash aggregation (partial + final)."""
    sensors = list(sensors or profile.sensors)
    derived = dict(KPI_DERIVED if derived is None else derived)
    aggs: list[Column] = []
    for s in sensors:
        aggs += [F.avg(s).alias(f"{s}_avg"), F.min(s).alias(f"{s}_min"),
                 F.max(s).alias(f"{s}_max"), F.stddev_samp(s).alias(f"{s}_std")]
    aggs.append(F.count(F.lit(1)).alias("reading_count"))
    if "is_anomaly" in df.columns:
        aggs.append(F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)).alias("anomaly_count"))
    if "anomaly_score" in df.columns:
        aggs.append(F.avg("anomaly_score").alias("avg_anomaly_score"))
    for src, out in derived.items():
        if src in df.columns:
            aggs.append(F.avg(src).alias(out))
    return df.groupBy(profile.asset, time_bucket(profile.ts, grain).alias(bucket_col)).agg(*aggs)


def with_health(df: DataFrame, temp: str | Column = "exhaust_gas_temp_c_avg",
                vibration: str | Column = "vibration_mm_s_avg",
                efficiency: str | Column = "avg_efficiency",
                anomaly: str | Column = "avg_anomaly_score") -> DataFrame:
    """Four health parts, composite health_score and risk_level.

    Inputs may be column names or expressions (profiles whose sensors are on
    another scale map them here).
    """
    conv = lambda x: F.expr(x) if isinstance(x, str) else x
    return df.withColumns(health_columns(conv(temp), conv(vibration), conv(efficiency),
                                         conv(anomaly)))


def latest_per_asset(df: DataFrame, asset: str, ts: str,
                     tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest row of every asset.

    ``max_by`` over a struct of the row is an aggregation, so partial
    aggregation keeps one candidate per asset per map task; a hot asset does
    not pile into one task as it would under ``row_number()`` per asset.
    """
    others = [c for c in df.columns if c != asset]
    key = F.struct(F.col(ts), *[F.col(c) for c in tiebreak])
    return df.groupBy(asset).agg(F.max_by(F.struct(*others), key).alias("_r")).select(
        asset, *[F.col(f"_r.{c}").alias(c) for c in others])


def alert_history(alarms: DataFrame, asset: str = "turbine_id", ts: str = "timestamp",
                  code: str = "alarm_code", severity: str = "severity",
                  value: str = "sensor_value", description: str = "alarm_description",
                  threshold: str = "threshold", tiebreak: Sequence[str] = (),
                  grain: str = "hour") -> DataFrame:
    """A2: alarms by asset, hour, code, severity: count, mean value, and the
    description/threshold of the earliest alarm (deterministic ``first``)."""
    key = F.struct(F.col(ts), *[F.col(c) for c in tiebreak])
    return alarms.groupBy(
        F.col(asset), time_bucket(ts, grain).alias("hour_bucket"), F.col(code), F.col(severity)
    ).agg(F.count(F.lit(1)).alias("occurrence_count"),
          F.avg(value).alias("avg_sensor_value"),
          F.min_by(F.col(description), key).alias("description"),
          F.min_by(F.col(threshold), key).alias("threshold"))


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """IO12: rows and columns per table, one union of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"))
        for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
