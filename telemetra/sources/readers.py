"""Batch sources (IO1, IO2, IO4, IO5, IO6, IO10)."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.profile import PIPELINE_SENSORS, SensorProfile

# Declared schemas of the raw tiers (timestamp and asset are non-null).
SENSOR_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampType(), False),
     T.StructField("turbine_id", T.StringType(), False)]
    + [T.StructField(s, T.DoubleType(), True) for s in PIPELINE_SENSORS]
    + [T.StructField("fault_type", T.StringType(), True),
       T.StructField("days_to_failure", T.DoubleType(), True),
       T.StructField("pressure_ratio", T.DoubleType(), True),
       T.StructField("heat_rate", T.DoubleType(), True),
       T.StructField("efficiency_pct", T.DoubleType(), True)])

ALARM_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("turbine_id", T.StringType(), False),
    T.StructField("alarm_code", T.StringType(), True),
    T.StructField("alarm_description", T.StringType(), True),
    T.StructField("severity", T.StringType(), True),
    T.StructField("sensor_value", T.DoubleType(), True),
    T.StructField("threshold", T.DoubleType(), True),
    T.StructField("acknowledged", T.BooleanType(), True),
])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Plain Parquet scan (filters and projections are pushed down)."""
    return spark.read.parquet(path)


def read_readings(spark: SparkSession, path: str, schema: T.StructType = SENSOR_SCHEMA,
                  nan_to_null: bool = True) -> DataFrame:
    """IO1: sensor Parquet with the declared schema; NaN sensor values -> null."""
    df = spark.read.schema(schema).parquet(path)
    if nan_to_null:
        dbl = [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]
        df = df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in dbl})
    return df


def read_alarms(spark: SparkSession, path: str) -> DataFrame:
    """IO2: alarm Parquet with the declared schema."""
    return spark.read.schema(ALARM_SCHEMA).parquet(path)


def read_csv_readings(spark: SparkSession, path: str, renames: Mapping[str, str],
                      schema: T.StructType | None = None) -> DataFrame:
    """IO4: CSV with unit-bearing headers renamed to snake_case.

    With ``schema`` (columns in the renamed names, file order) no inference
    pass is made; otherwise types are inferred once.
    """
    reader = spark.read.option("header", "true")
    if schema is not None:
        raw_names = list(renames.keys())
        # the file keeps its own headers; apply positional schema then rename
        df = reader.option("enforceSchema", "true").schema(T.StructType([
            T.StructField(raw, f.dataType, True) for raw, f in zip(raw_names, schema.fields)
        ])).csv(path)
    else:
        df = reader.option("inferSchema", "true").csv(path)
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


def assign_timestamps(df: DataFrame, order_cols: Sequence[str], end_ts, step_seconds: int = 60,
                      asset: str | None = None, ts_name: str = "timestamp") -> DataFrame:
    """IO5: synthetic timestamps by row order, ``step_seconds`` apart, last = ``end_ts``.

    The position comes from one sort by ranges of ``order_cols`` (of any
    types) and the row counts of its partitions
    (:func:`sequence.ordered_positions`); no partition holds the whole table.
    Within an asset (when given) numbering restarts per asset; a null asset is
    an asset.
    """
    from telemetra.operators import sequence as seq

    numbered = seq.ordered_positions(df, list(order_cols), asset)
    end = F.lit(end_ts).cast("timestamp")
    ts = F.timestamp_seconds(
        F.unix_seconds(end) - (F.col(seq.CNT) - F.col(seq.RN)) * F.lit(step_seconds))
    return numbered.withColumn(ts_name, ts).drop(seq.RN, seq.CNT)


def with_lineage(df: DataFrame, ts: str = "timestamp", quality_flag: str | None = "raw",
                 with_day: bool = True, source_col: str = "source_file") -> DataFrame:
    """IO10: ingestion time, source file, quality flag, year/month(/day)."""
    cols: dict[str, Column] = {
        "ingestion_timestamp": F.current_timestamp(),
        source_col: F.col("_metadata.file_path"),
    }
    if quality_flag is not None:
        cols["data_quality_flag"] = F.lit(quality_flag)
    cols["year"] = F.year(ts)
    cols["month"] = F.month(ts)
    if with_day:
        cols["day"] = F.dayofmonth(ts)
    return df.withColumns(cols)


def read_training(spark: SparkSession, source: str, profile: SensorProfile | None = None,
                  assets: Sequence | None = None) -> DataFrame:
    """IO6: training rows from a table name or a Parquet path.

    No ``toPandas``: the result stays distributed; ordering is a property of
    the consumers (they number rows per asset themselves).
    """
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    if assets is not None and profile is not None:
        df = df.filter(F.col(profile.asset).isin(list(assets)))
    return df


def apply_retention(df: DataFrame, ts: str, days: int, as_of,
                    partition_cols: tuple[str, str] | None = ("year", "month")) -> DataFrame:
    """IO11: keep rows younger than ``days`` at ``as_of``.

    When the table is partitioned by year/month, an extra predicate on those
    columns lets the scan skip whole partitions.
    """
    # a literal cutoff in the column's own type reaches the Parquet scan
    import datetime as _dt
    cut_py = _dt.datetime.fromisoformat(str(as_of)) - _dt.timedelta(days=days)
    out = df.filter(F.col(ts) >= F.lit(cut_py).cast(df.schema[ts].dataType))
    if partition_cols and all(c in df.columns for c in partition_cols):
        y, m = partition_cols
        out = out.filter((F.col(y) * 12 + F.col(m)) >= cut_py.year * 12 + cut_py.month)
    return out
