"""Streams equal batch on the same rows (availableNow over split files)."""

import datetime as dt
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.operators import alerts as AL
from telemetra.sources import sinks
from telemetra.streaming import streams as ST

T0 = dt.datetime(2025, 1, 1)
SCHEMA = T.StructType([T.StructField("asset", T.StringType()), T.StructField("ts", T.TimestampType()),
                       T.StructField("eid", T.StringType()), T.StructField("x", T.DoubleType())])


def write_files(base, n_files=4, per=150, seed=0):
    rng = random.Random(seed)
    rows = []
    os.makedirs(base, exist_ok=True)
    for f in range(n_files):
        chunk = []
        for i in range(per):
            ts = T0 + dt.timedelta(minutes=5 * (f * per + i))
            r = (rng.choice(["A", "B"]), ts, f"e{f}_{i}", round(rng.gauss(500, 30), 2))
            chunk.append(r)
        rows += chunk
        tbl = pa.table({"asset": [r[0] for r in chunk], "ts": pa.array([r[1] for r in chunk], pa.timestamp("us")),
                        "eid": [r[2] for r in chunk], "x": [r[3] for r in chunk]})
        pq.write_table(tbl, os.path.join(base, f"part-{f:03d}.parquet"))
    return rows


def run_to_memory(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_kpi_stream_equals_batch_on_closed_windows(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    write_files(src)
    s = ST.stream_readings(spark, src, SCHEMA, max_files_per_trigger=1, ts="ts")
    out = run_to_memory(ST.kpi_stream(s, "asset", "ts", ["x"], "1 hour", "10 minutes"), "kpi_s")
    batch = spark.read.schema(SCHEMA).parquet(src).groupBy(
        "asset", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"),
                                                          F.avg("x").alias("m"))
    b = {(r["asset"], r["w"]["start"]): (r["n"], r["m"]) for r in batch.collect()}
    got = out.collect()
    assert len(got) > 0
    for r in got:
        n, m = b[(r["asset"], r["window_start"])]
        assert r["reading_count"] == n and r["x_avg"] == pytest.approx(m)


def test_dedup_and_score_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    rows = write_files(src, n_files=2)
    extra = pa.table({"asset": [rows[0][0]], "ts": pa.array([rows[0][1]], pa.timestamp("us")),
                      "eid": ["dup"], "x": [1.0]})
    pq.write_table(extra, os.path.join(src, "part-999.parquet"))
    s = ST.stream_readings(spark, src, SCHEMA, ts="ts")
    d = ST.dedup_stream(s, ["asset", "ts"], "ts", "1 hour")
    sc = ST.score_stream(d, {"x": (500.0, 30.0)})
    out = run_to_memory(sc, "dedup_s")
    assert out.count() == len(rows)
    assert set(out.columns) >= {"health_score", "anomaly_score", "risk_level", "anomaly_label"}


def test_alert_stream_equals_batch_cooldown(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    write_files(src, n_files=4, per=100, seed=3)
    s = ST.stream_readings(spark, src, SCHEMA, max_files_per_trigger=1, ts="ts")
    viol = s.filter(F.col("x") > 510)
    out = run_to_memory(ST.alert_stream(viol, ["asset"], "ts", "eid", "x", cooldown_minutes=30,
                                        delay="1 day"), "alerts_s")
    batch = spark.read.schema(SCHEMA).parquet(src).filter(F.col("x") > 510).withColumnRenamed(
        "eid", "alert_id")
    want = sorted(r["alert_id"] for r in AL.apply_cooldown(
        batch, "ts", ["asset"], cooldown_col=None, cooldown_minutes=30).collect())
    assert sorted(r["event_id"] for r in out.collect()) == want


def test_ingest_stream_to_parquet_sink(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    rows = write_files(src, n_files=2)
    s = ST.ingest_stream(ST.stream_readings(spark, src, SCHEMA, ts="ts"), "ts")
    q = sinks.start_stream_sink(s, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"),
                                partitions=("year", "month"), available_now=True)
    q.awaitTermination()
    back = spark.read.parquet(os.path.join(tmp_dir, "out"))
    assert back.count() == len(rows)
    assert back.filter(F.col("source_file").contains("part-000")).count() == 150


def test_read_csv_readings_renames_headers(spark, tmp_dir):
    from telemetra.profile import SERVICE_CSV_RENAMES
    from telemetra.sources.readers import read_csv_readings
    path = os.path.join(tmp_dir, "svc.csv")
    headers = list(SERVICE_CSV_RENAMES)
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(headers) + "\n")
        f.write("900,15000,3500,2.0,100,2.5,150,500,120,0\n")
        f.write("1000,15900,3900,3.0,75,3.1,190,560,140,1\n")
    df = read_csv_readings(spark, path, SERVICE_CSV_RENAMES)
    assert df.columns == list(SERVICE_CSV_RENAMES.values())
    assert df.count() == 2 and df.agg(F.sum("fault")).first()[0] == 1


def late_files(base, n_files=6, per=60, seed=5):
    """Rows of three assets (one null) with missing and equal readings; some a file late, some repeated."""
    rng = random.Random(seed)
    os.makedirs(base, exist_ok=True)
    sent, rows = [[] for _ in range(n_files + 1)], []
    for f in range(n_files):
        for i in range(per):
            ts = T0 + dt.timedelta(minutes=5 * (f * per + i // 2))
            asset = rng.choice(["A", "B", None])
            x = None if rng.random() < 0.1 else (500.0 if asset == "B" and f < 2 else round(rng.gauss(500, 30), 2))
            r = (asset, ts, f * per + i, x)
            rows.append(r)
            draw = rng.random()
            for at in ([f + 1] if draw < 0.2 else [f, f, f + 1] if draw < 0.4 else [f]):
                sent[at].append(r)
    for f, chunk in enumerate(sent):
        rng.shuffle(chunk)
        pq.write_table(pa.table({
            "asset": pa.array([r[0] for r in chunk], pa.string()),
            "ts": pa.array([r[1] for r in chunk], pa.timestamp("us", "UTC")),
            "eid": pa.array([r[2] for r in chunk], pa.int64()), "x": pa.array([r[3] for r in chunk], pa.float64())}),
            os.path.join(base, f"part-{f:03d}.parquet"))
        os.utime(os.path.join(base, f"part-{f:03d}.parquet"), (1_700_000_000 + f, 1_700_000_000 + f))
    return rows


LATE = T.StructType([T.StructField("asset", T.StringType()), T.StructField("ts", T.TimestampType()),
                     T.StructField("eid", T.LongType()), T.StructField("x", T.DoubleType())])


def test_feature_stream_equals_batch_frames(spark, tmp_dir):
    from pyspark.sql import Window

    src = os.path.join(tmp_dir, "in")
    rows = late_files(src)
    s = ST.stream_readings(spark, src, LATE, max_files_per_trigger=1)
    out = ST.feature_stream(s, "asset", "ts", "eid", ["x"], lookback=12, sigma=1.5, min_sensors=1, delay="1 day")
    path = os.path.join(tmp_dir, "out")
    q = sinks.start_upsert_sink(out, path, os.path.join(tmp_dir, "ck"), available_now=True)
    q.awaitTermination()
    assert len([d for d in os.listdir(path) if d.startswith("epoch=")]) >= 7  # one per file
    got = {r["eid"]: r for r in sinks.read_upserts(spark, path, ["asset", "ts", "eid"], "version").collect()}
    o = Window.partitionBy("asset").orderBy("ts", "eid")
    w = o.rowsBetween(-12, 0)
    want = spark.createDataFrame(rows, LATE).select(
        "asset", "eid", "x", (F.col("x") - F.lag("x").over(o)).alias("rate"), F.when(
            F.stddev_samp("x").over(w) > 0, (F.col("x") - F.avg("x").over(w)) / F.stddev_samp("x").over(w))
        .otherwise(0.0).alias("z")).collect()
    assert len(got) == len(want) == len(rows)
    for r in want:
        g = got[r["eid"]]
        assert g["asset"] == r["asset"] and g["x"] == r["x"]
        for name, value in (("x_rate_of_change", r["rate"]), ("x_zscore", r["z"])):
            assert g[name] == (None if value is None else pytest.approx(value, abs=1e-9)), (name, r, g)
        assert g["is_anomaly"] == (r["z"] is not None and abs(r["z"]) > 1.5)


def test_feature_stream_empty(spark, tmp_dir):
    src, path = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    spark.createDataFrame([], LATE).coalesce(1).write.parquet(src)
    out = ST.feature_stream(ST.stream_readings(spark, src, LATE), "asset", "ts", "eid", ["x"])
    sinks.start_upsert_sink(out, path, os.path.join(tmp_dir, "ck"), available_now=True).awaitTermination()
    if os.path.exists(path):
        assert sinks.read_upserts(spark, path, ["asset", "ts", "eid"], "version").count() == 0


def test_kpi_stream_with_late_and_repeated_rows(spark, tmp_dir):
    src, path = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    rows = late_files(src, seed=6)
    s = ST.dedup_stream(ST.stream_readings(spark, src, LATE, max_files_per_trigger=1), ["asset", "ts", "eid"], "ts",
                        "1 day")
    out = ST.kpi_stream(s, "asset", "ts", ["x"], "1 hour", delay=None)
    sinks.start_upsert_sink(out, path, os.path.join(tmp_dir, "ck"), available_now=True).awaitTermination()
    got = {(r["asset"], r["window_start"]): (r["reading_count"], r["x_max"])
           for r in sinks.read_upserts(spark, path, ["asset", "window_start"]).collect()}
    want = {(r["asset"], r["w"]["start"]): (r["n"], r["m"]) for r in spark.createDataFrame(rows, LATE).groupBy(
        "asset", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("m")).collect()}
    assert got == want


def test_alert_stream_without_cooldown_fires_every_row(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    rows = write_files(src, n_files=2, per=40, seed=4)
    s = ST.stream_readings(spark, src, SCHEMA, max_files_per_trigger=1, ts="ts")
    out = run_to_memory(ST.alert_stream(s, ["asset"], "ts", "eid", "x", cooldown_minutes=0), "alerts_zero")
    assert sorted(r["event_id"] for r in out.collect()) == sorted(r[2] for r in rows)
