"""Structured Streaming operators (IO3, X1-X5).

* ``stream_readings``: incremental file stream with a declared schema.
* ``ingest_stream``: lineage columns on the stream (X1) -> ``sinks.start_stream_sink``.
* ``dedup_stream``: (asset, ts) dedup within a watermark (X2).
* ``score_stream``: stateless health / anomaly / risk per reading (X3).
* ``alert_stream``: rule evaluation with per-key cooldown kept in state
  (X4, ``applyInPandasWithState``: one timestamp per key).
* ``kpi_stream``: tumbling event-time windows with a watermark (X5).
* ``feature_stream``: rolling z-scores over row frames, kept in state (W4 on streams).
"""

from __future__ import annotations

from typing import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from telemetra.functions import scoring as SC


def stream_readings(spark: SparkSession, path: str, schema: T.StructType,
                    max_files_per_trigger: int | None = None, ts: str | None = None) -> DataFrame:
    """IO3: Parquet files arriving in ``path``; timestamp cast to TIMESTAMP
    (session zone) so watermarks accept it."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(path)
    if ts:
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def ingest_stream(df: DataFrame, ts: str) -> DataFrame:
    """Lineage on the stream: ingestion time, source file, year, month."""
    return df.withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "source_file": F.col("_metadata.file_path"),
        "year": F.year(ts), "month": F.month(ts)})


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Drop repeated keys seen within the watermark delay."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def score_stream(df: DataFrame, baselines: Mapping[str, tuple[float, float]],
                 fault_col: str | None = None) -> DataFrame:
    """Health (S8), anomaly (S9), risk (S7) and label (S12) per reading."""
    fault = F.col(fault_col) if fault_col else None
    out = df.withColumns({"health_score": SC.baseline_health(baselines, fault=fault),
                          "anomaly_score": SC.baseline_anomaly(baselines)})
    return out.withColumns({"risk_level": SC.risk_level("health_score"),
                            "anomaly_label": SC.anomaly_label("anomaly_score")})


def kpi_stream(df: DataFrame, asset: str, ts: str, sensors: Sequence[str],
               window: str = "1 hour", delay: str | None = "1 hour") -> DataFrame:
    """Per asset and tumbling window: count, avg/min/max/stddev per sensor.

    Append mode emits a window once the watermark passes its end; windows
    inside the final delay stay open.  Update mode emits every window that a
    batch changes, the last ones too, for ``sinks.start_upsert_sink``.
    ``delay`` is None where the stream has a watermark, as after X2."""
    aggs = [F.count(F.lit(1)).alias("reading_count")]
    for s in sensors:
        aggs += [F.avg(s).alias(f"{s}_avg"), F.min(s).alias(f"{s}_min"),
                 F.max(s).alias(f"{s}_max"), F.stddev_samp(s).alias(f"{s}_std")]
    marked = df.withWatermark(ts, delay) if delay else df
    out = marked.groupBy(F.col(asset), F.window(ts, window)).agg(*aggs)
    return out.select(asset, F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), *[c for c in out.columns
                                                               if c not in (asset, "window")])


ALERT_OUT = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("event_id", T.StringType()),
    T.StructField("ts", T.TimestampType()), T.StructField("value", T.DoubleType()),
])
ALERT_STATE = T.StructType([T.StructField("last_fired_us", T.LongType())])


def alert_stream(violations: DataFrame, key_cols: Sequence[str], ts: str, id_col: str,
                 value_col: str, cooldown_minutes: float, delay: str = "1 hour") -> DataFrame:
    """Cooldown across micro-batches.

    ``violations`` are rule violations (e.g. from ``alerts.evaluate_rules``
    on the stream).  State per key = last fired time (one long); inside a
    batch the key's rows are sorted by time and fired greedily.  A late row
    (before the last fired time) can never fire, so closed intervals are not
    reopened.  State expires through the event-time timeout after the
    watermark passes last_fired + cooldown.  Without a cooldown every row
    fires, late ones too, and no state is kept.
    """
    cd_us = int(cooldown_minutes * 60_000_000)
    keyed = violations.withWatermark(ts, delay).withColumn(
        "_key", F.concat_ws("\u0001", *[F.col(c).cast("string") for c in key_cols])) \
        .select("_key", F.col(id_col).cast("string").alias("_id"), F.col(ts).alias("_ts"),
                F.col(value_col).cast("double").alias("_v"))
    if cd_us <= 0:
        return keyed.select(F.col("_key").alias("key"), F.col("_id").alias("event_id"), F.col("_ts").alias("ts"),
                            F.col("_v").alias("value"))

    def fold(key, pdfs, state):
        last = state.get[0] if state.exists else None
        fired = []
        if state.hasTimedOut:
            state.remove()
            return
        frames = [p for p in pdfs]
        if not frames:
            return
        pdf = pd.concat(frames).sort_values(["_ts", "_id"])
        t_us = (pdf["_ts"].astype("int64") // 1000).to_numpy()
        for i, t in enumerate(t_us):
            if last is None or t - last >= cd_us:
                last = int(t)
                fired.append(i)
        state.update((last,))
        # a timeout must lie behind the watermark
        state.setTimeoutTimestamp(max(last // 1000 + cd_us // 1000, state.getCurrentWatermarkMs() + 1))
        if fired:
            sel = pdf.iloc[fired]
            yield pd.DataFrame({"key": key[0], "event_id": sel["_id"].to_numpy(),
                                "ts": sel["_ts"].to_numpy(), "value": sel["_v"].to_numpy()})

    return keyed.groupBy("_key").applyInPandasWithState(
        fold, ALERT_OUT, ALERT_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def feature_stream(df: DataFrame, asset: str, ts: str, id_col: str, sensors: Sequence[str],
                   lookback: int = 288, sigma: float = 3.0, min_sensors: int = 2,
                   delay: str = "1 hour") -> DataFrame:
    """W2 and W4 on a stream: rate of change and rolling z-score over the last ``lookback`` rows.

    State of an asset: its rows of the last ``delay`` (event time) and the
    ``lookback`` rows before them, as arrays in the order of (ts, id).  An
    arriving row is put in its place; it and the up to ``lookback`` rows after
    it are emitted with their features, under a ``version`` that grows.  So a
    late row corrects rows that are out already, and the last rows do not wait
    for a watermark: take the greatest version of each (asset, ts, id), as
    :func:`sinks.start_upsert_sink` and :func:`sinks.read_upserts` do.

    Rows of an (asset, ts, id) that is held already are dropped, as are those
    older than the watermark and those without a time or id (an integer).
    Null and NaN readings are missing: no part of mean and std, null z-score
    where std > 0.  Assets may be null.  Memory of a task: the state of one
    asset and one Arrow batch of its rows.
    """
    sensors, k = list(sensors), len(sensors)
    keyed = df.filter(F.col(ts).isNotNull() & F.col(id_col).isNotNull()).withWatermark(ts, delay).select(
        F.col(asset).alias("_asset"), F.col(ts).alias("_ts"), F.unix_micros(ts).alias("_us"),
        F.col(id_col).cast("long").alias("_id"), *[F.col(s).cast("double").alias(s) for s in sensors])
    out = T.StructType([T.StructField(asset, df.schema[asset].dataType), T.StructField("us", T.LongType()),
                        T.StructField(id_col, T.LongType()), T.StructField("version", T.LongType())]
                       + [T.StructField(f"{s}{end}", T.DoubleType()) for s in sensors
                          for end in ("", "_rate_of_change", "_zscore")]
                       + [T.StructField(f"{s}_anomaly", T.IntegerType()) for s in sensors]
                       + [T.StructField("anomaly_score", T.IntegerType()), T.StructField("is_anomaly", T.BooleanType())])
    held = T.StructType([T.StructField("us", T.ArrayType(T.LongType())), T.StructField("id", T.ArrayType(T.LongType())),
                         T.StructField("values", T.ArrayType(T.DoubleType())), T.StructField("version", T.LongType())])

    def step(key, pdfs, state):
        us, ids, x, version = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, k)), 0
        if state.exists:
            us, ids, x, version = state.get
            us, ids = np.array(us, np.int64), np.array(ids, np.int64)
            x = np.array(x, float).reshape(-1, k)
        mark = state.getCurrentWatermarkMs() * 1000
        for pdf in pdfs:
            pdf = pdf[pdf["_us"] >= mark].drop_duplicates(["_us", "_id"])
            new_us, new_ids = pdf["_us"].to_numpy(np.int64), pdf["_id"].to_numpy(np.int64)
            known = set(zip(us.tolist(), ids.tolist()))
            fresh = np.array([p not in known for p in zip(new_us.tolist(), new_ids.tolist())], bool)
            if not fresh.any():
                continue
            arrived = np.concatenate([np.zeros(len(us), bool), np.ones(fresh.sum(), bool)])
            us, ids = np.concatenate([us, new_us[fresh]]), np.concatenate([ids, new_ids[fresh]])
            x = np.concatenate([x, pdf[sensors].to_numpy(float)[fresh]])
            order = np.lexsort((ids, us))
            us, ids, x, arrived = us[order], ids[order], x[order], arrived[order]
            so_far = np.concatenate([np.zeros(lookback + 1, np.int64), np.cumsum(arrived)])
            at = np.flatnonzero(so_far[lookback + 1:] > so_far[:len(us)])
            version += 1
            yield _features(asset, id_col, sensors, key[0], us, ids, x, at, version, lookback, sigma, min_sensors)
            # rows before the watermark are only looked back at from now on
            first = max(0, int(np.searchsorted(us, mark)) - lookback)
            us, ids, x = us[first:], ids[first:], x[first:]
        state.update((us.tolist(), ids.tolist(), x.ravel().tolist(), version))

    rows = keyed.groupBy("_asset").applyInPandasWithState(step, out, held, "update", GroupStateTimeout.NoTimeout)
    return rows.select(asset, F.timestamp_micros("us").alias(ts), *[F.col(c) for c in rows.columns[2:]])


def _features(asset, id_col, sensors, key, us, ids, x, at, version, lookback, sigma, min_sensors) -> pd.DataFrame:
    """The rows at places ``at`` of ordered rows, with their features (``None`` for missing values)."""
    cols = {asset: pd.Series([key] * len(at), dtype=object), "us": us[at], id_col: ids[at],
            "version": np.full(len(at), version)}
    score = np.zeros(len(at), np.int32)
    flags = {}
    for j, s in enumerate(sensors):
        padded = np.concatenate([np.full(lookback, np.nan), x[:, j]])
        z = np.zeros(len(at))
        for lo in range(0, len(at), 4096):
            part = at[lo:lo + 4096]
            w = np.lib.stride_tricks.sliding_window_view(padded, lookback + 1)[part]
            seen = ~np.isnan(w)
            n = seen.sum(axis=1)
            # shifted by the least value: equal readings have a spread of exactly 0
            d = np.where(seen, w - np.fmin.reduce(w, axis=1)[:, None], 0.0)
            mean = d.sum(axis=1) / np.maximum(n, 1)
            var = np.where(seen, (d - mean[:, None]) ** 2, 0.0).sum(axis=1) / np.maximum(n - 1, 1)
            std = np.where(d.max(axis=1) > 0, np.sqrt(var), 0.0)
            wide = (n > 1) & (std > 0)
            z[lo:lo + 4096][wide] = (d[wide, -1] - mean[wide]) / std[wide]
            z[lo:lo + 4096][wide & ~seen[:, -1]] = np.nan
        before = np.concatenate([[np.nan], x[:-1, j]])[at]
        cols[s], cols[f"{s}_rate_of_change"], cols[f"{s}_zscore"] = x[at, j], x[at, j] - before, z
        flags[f"{s}_anomaly"] = (np.abs(z) > sigma).astype(np.int32)
        score += flags[f"{s}_anomaly"]
    return pd.DataFrame({**cols, **flags, "anomaly_score": score, "is_anomaly": score >= min_sensors})
