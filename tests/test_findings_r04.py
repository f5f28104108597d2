"""Findings of round 4 on the telemetry operators."""

import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from telemetra.operators import clean as C
from telemetra.operators import sequence as seq
from telemetra.plans import batch
from telemetra.profile import SensorProfile
from telemetra.session import scratch_path, step_files, written

PROFILE = SensorProfile(asset="a", ts="t", sensors=("x", "y"), tiebreak=("x", "y"), block_rows=8, chunk_seconds=1024 * 60,
                        limits={"x": (0.0, 90.0)})


def readings(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(a, start + dt.timedelta(seconds=17 * i), float(i * 7 % 95), None if i % 5 == 3 or i % 11 < 2 else 1.0 * i)
            for a, n in ((1, 60), (2, 3), (None, 30), (4, 1)) for i in range(n)]
    return spark.createDataFrame([*rows, *rows[:9], (1, None, 1.0, 2.0)], "a long, t timestamp, x double, y double")


def places(df):
    return sorted(map(str, df.select("a", "t", "x", "y", seq.RN).collect()))


def test_rows_are_numbered_without_their_count(spark):
    """Rows are numbered as before, and no join sends them by their block."""
    df = readings(spark).repartition(3)
    want = places(C.clean_readings(df, PROFILE, keep_sequence=True))
    got = C.clean_readings(df, PROFILE, keep_sequence=True, with_count=False)
    assert places(got) == want and seq.CNT not in got.columns
    assert len(want) > 60 and max(r[seq.RN] for r in got.collect()) > 3 * PROFILE.block_rows
    direct = C.clean_readings(df, PROFILE, strategy="direct", keep_sequence=True, with_count=False)
    assert places(direct) == want and direct.columns == got.columns

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a table of many assets is never small enough
    try:
        plan = C.clean_readings(df, PROFILE, keep_sequence=True, with_count=False)._jdf.queryExecution().executedPlan()
        assert "SortMergeJoin" not in plan.toString() and "BroadcastHashJoin" in plan.toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}


def gone(files):
    for _ in range(100):  # files are deleted in the background
        if not any(map(os.path.exists, files)):
            return True
        time.sleep(0.1)
    return False


def test_a_step_leaves_only_its_result(spark, tmp_path):
    before, tables = shuffle_files(spark), scratch_path(spark, "")
    free = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(free, None)
    held = written(spark.range(3).toDF("kept"), "kept-table")
    with pytest.raises(ZeroDivisionError):
        with step_files(spark):
            mid = written(spark.range(100).selectExpr("id % 7 AS k").groupBy("k").agg(F.count("k").alias("n")), "step-table")
            mid.groupBy("n").count().write.parquet(f"{tmp_path}/out")
            assert any("step-table" in t for t in os.listdir(tables.removeprefix("file:")))
            1 / 0
    assert spark.conf.get(free, None) == was and gone(shuffle_files(spark) - before)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2 and held.count() == 3
    assert not any("step-table" in t for t in os.listdir(tables.removeprefix("file:")))


def test_batch_flow_frees_the_disk_between_tiers(spark, tmp_path, monkeypatch):
    """When a tier is recorded, its shuffles and scratch tables are gone (or going)."""
    seen, record = [], batch._Run.record
    before, tables = shuffle_files(spark), scratch_path(spark, "").removeprefix("file:")
    known = set(os.listdir(tables)) if os.path.exists(tables) else set()
    monkeypatch.setattr(batch._Run, "record", lambda self, tier, *rest: (
        seen.append((tier, sorted(set(os.listdir(tables)) - known) if os.path.exists(tables) else [])),
        record(self, tier, *rest))[1])
    frees, of = [], batch.step_files
    monkeypatch.setattr(batch, "step_files", lambda s: frees.append(1) or of(s))
    log = batch.run_batch(spark, readings(spark), None, PROFILE, f"{tmp_path}/flow", dict(
        temp="x_avg", vibration="y_avg", efficiency="x_avg", anomaly="avg_anomaly_score"), stop_on_gate_failure=False)
    assert gone({f for f in shuffle_files(spark) - before if os.path.getsize(f) > 2000})  # counts and the ledger are small
    assert log.count() == len(seen) == 8 and len(frees) == 6
    assert {t for t, _ in seen} >= {"bronze", "silver", "gold"} and not any(left for _, left in seen)
    silver = spark.read.parquet(f"{tmp_path}/flow/silver")
    assert silver.count() == C.clean_readings(readings(spark), PROFILE).count() > 60
