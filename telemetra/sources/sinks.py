"""Sinks and persistence (IO7, IO8, IO9, IO13, IO14)."""

from __future__ import annotations

import json
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_append(df: DataFrame, path: str, partitions: Sequence[str] = ("year", "month"),
                 max_records_per_file: int | None = None, replace_sources: bool = False,
                 source_col: str = "source_file") -> None:
    """IO7: append, partitioned (e.g. by year, month, asset).

    ``replace_sources`` makes re-runs idempotent by source file: the table is
    partitioned by ``source_col`` first and only the partitions of the sources
    in ``df`` are overwritten, so ingesting a file again replaces its rows and
    an increment of the same month keeps the earlier ones.  Partitions that a
    corrected file no longer has stay: :func:`commit_sources` replaces whole
    sources.
    """
    w = df.write.partitionBy(*([source_col] if replace_sources else []), *partitions)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if replace_sources:
        w.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    else:
        w.mode("append").parquet(path)


def commit_sources(df: DataFrame, path: str, partitions: Sequence[str] = ("year", "month"),
                   source_col: str = "source_file", batch: str | None = None,
                   sources: Sequence[str] | None = None) -> bool:
    """IO7/IO9: replace the rows of the sources in ``df``, by a ledger of commits.

    The rows are written beside the older ones, under a batch of their own;
    then the ledger gets one row per source that names its batch, and
    :func:`read_committed` reads each source's last one.  So a source that is
    ingested again has its new rows only (also where it lost whole
    partitions), a write that fails leaves the table as it was, and a batch
    that the ledger knows is not written twice (a stream passes its epoch).
    ``sources`` names sources explicitly, for those that have no rows left.
    Returns whether the batch was committed now.
    """
    spark = df.sparkSession
    batch = batch or uuid.uuid4().hex
    ledger = _ledger(spark, path)
    done = ledger.agg(F.coalesce(F.max("number"), F.lit(0)).alias("n"),
                      F.coalesce(F.max(F.col("batch") == batch), F.lit(False)).alias("known")).first()
    if done["known"]:
        return False
    df.withColumn("batch", F.lit(batch)).write.partitionBy("batch", *partitions).mode("append").parquet(f"{path}/data")
    named = df.select(F.col(source_col).cast("string").alias("source")).distinct()
    if sources is not None:
        named = named.union(spark.createDataFrame([(s,) for s in sources], "source string")).distinct()
    named.select("source", F.lit(batch).alias("batch"), F.lit(done["n"] + 1).cast("long").alias("number")) \
        .write.mode("append").parquet(f"{path}/ledger")
    return True


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    schema = "source string, batch string, number long"
    if not _exists(spark, f"{path}/ledger"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/ledger")


def read_committed(spark: SparkSession, path: str, source_col: str = "source_file") -> DataFrame:
    """The rows of every source's last committed batch."""
    live = _ledger(spark, path).groupBy(F.col("source").alias("_source")).agg(
        F.max_by("batch", "number").alias("_batch"))
    data = spark.read.parquet(f"{path}/data")
    return data.join(live, data["batch"].eqNullSafe(F.col("_batch"))
                     & data[source_col].cast("string").eqNullSafe(F.col("_source")), "left_semi").drop("batch")


def vacuum_sources(spark: SparkSession, path: str) -> list[str]:
    """Delete the batches that no source's last commit names; returns their names."""
    ledger = _ledger(spark, path)
    live = ledger.groupBy("source").agg(F.max_by("batch", "number").alias("batch")).select("batch").distinct()
    dead = [r["batch"] for r in ledger.select("batch").distinct().join(live, "batch", "left_anti").collect()]
    for batch in dead:  # one folder per batch
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data/batch={batch}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return dead


def start_ledger_sink(df: DataFrame, path: str, checkpoint: str, name: str,
                      partitions: Sequence[str] = ("year", "month"), source_col: str = "source_file",
                      available_now: bool = False) -> StreamingQuery:
    """IO9: streaming append through the ledger; an epoch that is run again is committed once."""
    def commit(batch: DataFrame, epoch: int) -> None:
        commit_sources(batch, path, partitions, source_col, batch=f"{name}-{epoch}")

    w = df.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def start_upsert_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """IO9: update-mode stream into a folder per epoch; an epoch that is run again replaces its folder.

    Read with :func:`read_upserts`.
    """
    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    w = df.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def read_upserts(spark: SparkSession, path: str, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """The last row of every key: of its last epoch, and there of the greatest ``version``.

    An aggregation with map-side combine; null keys are keys like others.
    """
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "epoch", version)]
    last = F.struct("epoch", version) if version else F.col("epoch")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), last).alias("_last")).select(*keys, "_last.*")


def write_overwrite(df: DataFrame, path: str, partitions: Sequence[str] = (),
                    cluster_by: Sequence[str] = (), max_records_per_file: int | None = None) -> None:
    """IO8: overwrite with the new schema (Parquet replaces the files).

    ``cluster_by`` repartitions by those columns first so each asset lands in
    few files and later per-asset reads prune well.
    """
    out = df.repartition(*[F.col(c) for c in cluster_by]) if cluster_by else df
    w = out.write.mode("overwrite")
    if partitions:
        w = w.partitionBy(*partitions)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def start_stream_sink(df: DataFrame, path: str, checkpoint: str,
                      partitions: Sequence[str] = ("year", "month"), available_now: bool = False,
                      processing_time: str | None = None) -> StreamingQuery:
    """IO9: streaming append to Parquet with a checkpoint (exactly-once files)."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", path))
    if partitions:
        w = w.partitionBy(*partitions)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def export_sample(df: DataFrame, path: str, n: int = 1000, order: Sequence[str] = ()) -> None:
    """IO14: first ``n`` rows (by ``order``) as one CSV file with header."""
    x = df.orderBy(*order) if order else df
    x.limit(n).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    """IO14: a one-row summary DataFrame as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def save_iforest(model, spark: SparkSession, path: str) -> None:
    """IO13: isolation forest as Parquet (node table) + JSON metadata."""
    spark.createDataFrame(model.nodes).write.mode("overwrite").parquet(f"{path}/nodes")
    meta = {"features": model.features, "means": model.means, "stds": model.stds,
            "max_samples": model.max_samples, "offset": model.offset}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/meta")


def load_iforest(spark: SparkSession, path: str):
    """IO13: inverse of :func:`save_iforest`."""
    from telemetra.operators.anomaly import IForestModel
    nodes = spark.read.parquet(f"{path}/nodes").toPandas()  # bounded: the forest
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return IForestModel(meta["features"], meta["means"], meta["stds"], nodes,
                        meta["max_samples"], meta["offset"])


def save_forecaster(model, spark: SparkSession, path: str) -> None:
    """IO13: forecaster as an ML pipeline (scaler and regressors) + JSON metadata."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    meta = {"features": model.features, "targets": model.targets, "seq_len": model.seq_len,
            "horizon": model.horizon}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/meta")


def load_forecaster(spark: SparkSession, path: str):
    """IO13: inverse of :func:`save_forecaster`."""
    from pyspark.ml import PipelineModel

    from telemetra.operators.trend import ForecasterModel
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return ForecasterModel(PipelineModel.load(f"{path}/pipeline"), meta["features"], meta["targets"],
                           meta["seq_len"], meta["horizon"])


def save_stats(df: DataFrame, path: str) -> None:
    """IO13: baselines / drift statistics as a Parquet table."""
    df.write.mode("overwrite").parquet(path)
