"""Latest-N rows and row queries per asset.

"The last n rows of an asset" are a descending top-k, which Spark prunes
before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra.operators import sequence as seq
from telemetra.profile import SensorProfile

POS = "pos_from_end"


def last_n_rows(df: DataFrame, profile: SensorProfile, n: int, keep_position: bool = False) -> DataFrame:
    """The newest ``n`` rows of every asset (row count, not time).

    A descending top-k: every map task keeps at most ``n`` rows of an asset,
    so neither the table nor a hot asset is sorted as a whole.  With
    ``keep_position``, ``pos_from_end`` numbers them from 1, the newest.
    """
    newest = Window.partitionBy(profile.asset).orderBy(*profile.order_exprs(descending=True))
    out = df.drop(seq.RN, seq.CNT).withColumn(POS, F.row_number().over(newest)).filter(F.col(POS) <= n)
    return out if keep_position else out.drop(POS)


def last_hours(df: DataFrame, profile: SensorProfile, hours: float, as_of,
               partition_cols: tuple[str, str] | None = None) -> DataFrame:
    """J2 (time variant): rows newer than ``as_of - hours``; with year/month
    partition columns an extra predicate prunes partitions."""
    # bounds in the column's own type, so the predicate reaches the Parquet scan
    import datetime as _dt
    dt = df.schema[profile.ts].dataType
    end_py = _dt.datetime.fromisoformat(str(as_of))
    end = F.lit(end_py).cast(dt)
    start = F.lit(end_py - _dt.timedelta(hours=hours)).cast(dt)
    out = df.filter((F.col(profile.ts) > start) & (F.col(profile.ts) <= end))
    if partition_cols and all(c in df.columns for c in partition_cols):
        y, m = partition_cols
        first = end_py - _dt.timedelta(hours=hours)
        out = out.filter(F.col(y) * 12 + F.col(m) >= first.year * 12 + first.month)
    return out


def sensor_trend(df: DataFrame, profile: SensorProfile, sensor: str, n: int) -> DataFrame:
    """(asset, timestamp, value rounded to 4) over the last n rows."""
    if sensor not in df.columns:
        raise ValueError(f"unknown sensor {sensor!r}")
    last = last_n_rows(df, profile, n)
    return last.select(profile.asset, F.col(profile.ts).alias("timestamp"),
                       F.round(F.col(sensor).cast("double"), 4).alias("value"))


def query_readings(df: DataFrame, profile: SensorProfile, n: int = 20, fault_only: bool = False,
                   sensor: str | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """Optional fault filter (applied before the tail), last n rows,
    optional single-sensor projection."""
    x = df.filter(profile.fault_col() == 1) if fault_only else df
    x = last_n_rows(x, profile, n)
    sensors = [sensor] if sensor and sensor in df.columns else list(profile.sensors)
    return x.select(profile.asset, profile.ts, *extra, *sensors)


def latest_status(df: DataFrame, profile: SensorProfile, window_rows: int = 288,
                  health_col: str = "health_score") -> DataFrame:
    """A10: newest row per asset with its health/risk and the number of fault
    rows among the last ``window_rows`` rows (reported as active alerts)."""
    tail = last_n_rows(df, profile, window_rows)
    key = F.struct(*[F.col(c) for c in profile.order_cols])
    cols = [c for c in df.columns if c != profile.asset]
    agg = tail.groupBy(profile.asset).agg(
        F.sum(profile.fault_col()).alias("active_alerts"),
        F.max_by(F.struct(*cols), key).alias("_r"))
    return agg.select(profile.asset, *[F.col(f"_r.{c}").alias(c) for c in cols],
                      F.col("active_alerts").cast("long"))
