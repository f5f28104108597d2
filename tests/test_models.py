"""Isolation forest, forecaster, persistence, exports, acks, tiered flow."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetra.operators import alerts as AL
from telemetra.operators import anomaly as AN
from telemetra.operators import trend as TR
from telemetra.profile import SensorProfile
from telemetra.sources import sinks

T0 = dt.datetime(2025, 1, 1)


def blobs(spark, n=3000, outliers=30, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3))
    x[:outliers] += 8.0  # planted outliers
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double")


def test_iforest_finds_planted_outliers(spark, tmp_dir):
    df = blobs(spark)
    model = AN.train_iforest(df, ["a", "b", "c"], n_trees=50, max_samples=128,
                             contamination=0.02, seed=7)
    scored = AN.score_iforest(df, model, normalise="batch").cache()
    top = [r["id"] for r in scored.orderBy(F.col("anomaly_score").desc()).limit(30).collect()]
    assert sum(1 for i in top if i < 30) >= 27
    assert 0.005 <= scored.filter("is_anomaly").count() / 3000 <= 0.05
    summ = AN.score_summary(scored).first()
    assert summ["total_records"] == 3000 and summ["max_anomaly_score"] == pytest.approx(1.0)
    # persistence round trip gives identical scores
    sinks.save_iforest(model, spark, os.path.join(tmp_dir, "forest"))
    back = sinks.load_iforest(spark, os.path.join(tmp_dir, "forest"))
    s2 = AN.score_iforest(df, back, normalise=None).select("id", "score_samples")
    s1 = scored.select("id", "score_samples")
    assert s1.exceptAll(s2).count() == 0


@pytest.mark.parametrize("n", [3000, 200])
def test_iforest_samples_rows_not_readings(spark, n):
    """A third of the rows share one reading: every tree sees it at about its share, at both sizes."""
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(5)).alias("a"))
    df = spark.createDataFrame(df.collect(), df.schema)
    trees, psi = 20, 64
    sample = AN._samples(df, ["a"], ["id"], n, trees, psi, 3).groupBy("tree_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("a") == 0.5).cast("int")).alias("hot"),
        F.countDistinct("a").alias("d"), F.count_if(F.col("a") != 0.5).alias("others")).collect()
    assert len(sample) == trees and all(r["n"] == psi for r in sample)
    assert all(0.1 < r["hot"] < 0.6 and r["d"] == r["others"] + 1 for r in sample)
    grown = [AN.train_iforest(x, ["a"], n_trees=trees, max_samples=psi, contamination=None, seed=3).nodes
             for x in (df, df.orderBy(F.desc("id")).repartition(5))]
    shape = [sorted(g[["tree_id", "node_id", "feature", "left", "right", "size"]].values.tolist()) for g in grown]
    assert shape[0] == shape[1]


def test_forecaster_learns_linear_trend(spark):
    rows = [("A", T0 + dt.timedelta(minutes=5 * i), float(i), 2.0 * i) for i in range(200)]
    df = spark.createDataFrame(rows, "a string, ts timestamp, x double, y double")
    p = SensorProfile(asset="a", ts="ts", sensors=("x", "y"))
    model, metrics = TR.train_forecaster(df, p, ["x"], ["y"], seq_len=8, horizon=2,
                                         loss="squaredError", max_iter=100)
    val = [r["mae"] for r in metrics.filter("split = 'validation'").collect()]
    assert max(val) < 0.5
    fc = {r["step"]: r["value"] for r in TR.forecast(model, df, p).collect() if r["sufficient_data"]}
    assert fc[1] == pytest.approx(400.0, abs=1.0) and fc[2] == pytest.approx(402.0, abs=1.0)
    short = spark.createDataFrame(rows[:3], "a string, ts timestamp, x double, y double")
    assert TR.forecast(model, short, p).first()["sufficient_data"] is False


def test_forecaster_saved_and_loaded(spark, tmp_dir):
    """Two targets, one of them no feature; a loaded model forecasts the same; naive errors by hand."""
    rows = [(a, T0 + dt.timedelta(minutes=5 * i), float(i % 7), 3.0 * i + k) for k, a in enumerate("AB")
            for i in range(60)]
    df = spark.createDataFrame(rows, "a string, ts timestamp, x double, y double")
    p = SensorProfile(asset="a", ts="ts", sensors=("x", "y"))
    model, metrics = TR.train_forecaster(df, p, ["x"], ["x", "y"], seq_len=8, horizon=2, loss="squaredError")
    got = {(r["output"], r["split"]): r for r in metrics.collect()}
    assert len(got) == 8
    windows = 60 - 8 - 2 + 1
    train = windows * 8 // 10
    assert {k[1]: r["n"] for k, r in got.items()} == {"train": 2 * train, "validation": 2 * (windows - train)}
    assert got[1, "validation"]["naive_mae"] == pytest.approx(3.0)  # y, one step on
    assert got[3, "validation"]["naive_mae"] == pytest.approx(6.0)
    assert got[0, "validation"]["mae"] < 1e-6 < got[0, "validation"]["naive_mae"]  # x has a period of 7
    sinks.save_forecaster(model, spark, os.path.join(tmp_dir, "forecaster"))
    loaded = sinks.load_forecaster(spark, os.path.join(tmp_dir, "forecaster"))

    def rows_of(m):
        return sorted(map(tuple, TR.forecast(m, df, p).collect()))
    assert rows_of(model) == rows_of(loaded) and len(rows_of(model)) == 8
    assert {(r[0], r[1]): r[3] for r in rows_of(loaded) if r[2] == "x"} == {
        (a, k): pytest.approx((59 + k) % 7, abs=1e-3) for a in "AB" for k in (1, 2)}


def test_alert_log_acks_exports(spark, tmp_dir):
    ev = spark.createDataFrame([(f"id{i}", T0 + dt.timedelta(minutes=i), False) for i in range(5)],
                               "alert_id string, timestamp timestamp, acknowledged boolean")
    assert [r["alert_id"] for r in AL.alert_log(ev, "timestamp", 2).collect()] == ["id4", "id3"]
    acks = spark.createDataFrame([("id1", "op", T0), ("id1", "op2", T0 + dt.timedelta(hours=1))],
                                 "alert_id string, acknowledged_by string, acknowledged_at timestamp")
    out = {r["alert_id"]: r for r in AL.apply_acks(ev, acks).collect()}
    assert out["id1"]["acknowledged"] and out["id1"]["acknowledged_by"] == "op2"
    assert not out["id0"]["acknowledged"]
    sinks.export_sample(ev, os.path.join(tmp_dir, "csv"), n=3, order=["timestamp"])
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "csv")).count() == 3
    sinks.write_summary(ev.agg(F.count(F.lit(1)).alias("n")), os.path.join(tmp_dir, "js"))
    assert spark.read.json(os.path.join(tmp_dir, "js")).first()["n"] == 5


def test_tiered_batch_flow(spark, tmp_dir):
    from telemetra.plans.batch import run_batch
    from telemetra.plans.catalog import LINEITEM, LINEITEM_HEALTH, lineitem_readings, orders_alarms
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("driver data absent")
    raw = lineitem_readings(spark, sf)
    health = dict(LINEITEM_HEALTH)
    log = run_batch(spark, raw, orders_alarms(spark, sf), LINEITEM, os.path.join(tmp_dir, "lake"),
                    health, kpi_grain="month", stop_on_gate_failure=False)
    tiers = {r["tier"]: r for r in log.collect()}
    assert tiers["bronze"]["rows"] == raw.count()
    assert tiers["silver"]["rows"] > 0 and tiers["gold"]["rows"] > 0
    # several lines of one supplier and day: the duplicate gate fails, and it alone
    assert tiers["bronze gates"]["status"] == "failed:1" and tiers["gates"]["status"] == "failed:1"
    assert tiers["silver gates"]["status"] == tiers["gold gates"]["status"] == "passed"
    # running again replaces the source's rows instead of adding to them
    run_batch(spark, raw, None, LINEITEM, os.path.join(tmp_dir, "lake"), health,
              kpi_grain="month", stop_on_gate_failure=False)
    assert sinks.read_committed(spark, os.path.join(tmp_dir, "lake", "bronze")).count() == raw.count()


def test_batch_flow_resumes_at_the_failed_gate(spark, tmp_dir, monkeypatch):
    from telemetra.operators import features as FT
    from telemetra.plans.batch import GateFailure, run_batch
    from telemetra.plans.catalog import LINEITEM, LINEITEM_HEALTH, lineitem_readings
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("driver data absent")
    raw, base = lineitem_readings(spark, sf), os.path.join(tmp_dir, "lake")
    built = []
    features = FT.silver_features
    monkeypatch.setattr(FT, "silver_features", lambda *a, **k: (built.append(1), features(*a, **k))[1])
    limits = {"max_duplicate_percentage": 100.0, "required_tables": ("gold_turbine_hourly_kpis",)}

    def start(**more):
        return {r["tier"]: r["status"] for r in run_batch(
            spark, raw, None, LINEITEM, base, dict(LINEITEM_HEALTH), kpi_grain="month", run="r1",
            gate_config=limits | more).collect()}

    with pytest.raises(GateFailure):
        start(max_null_percentage=-1.0)
    assert not built and not os.path.exists(os.path.join(base, "silver"))
    with pytest.raises(GateFailure):
        start(required_features_count=1000)
    assert len(built) == 1 and not os.path.exists(os.path.join(base, "gold_kpis"))
    log = start()
    assert len(built) == 1 and "silver" not in log and log["gold"] == "written" and log["gates"] == "passed"


def test_ledger_replaces_whole_sources(spark, tmp_dir):
    """A corrected file that lost a month, a batch run twice, a source without rows, a failed write."""
    path = os.path.join(tmp_dir, "ledger")
    cols = "source_file string, year int, month int, v int"

    def commit(rows, batch, **more):
        return sinks.commit_sources(spark.createDataFrame(rows, cols), path, batch=batch, **more)

    def now():
        return sorted((r["source_file"], r["month"], r["v"]) for r in sinks.read_committed(spark, path).collect())

    assert commit([("f1", 2024, 1, 1), ("f1", 2024, 2, 2), ("f2", 2024, 1, 3)], "b1")
    assert commit([("f1", 2024, 2, 20)], "b2")
    assert now() == [("f1", 2, 20), ("f2", 1, 3)]
    assert not commit([("f1", 2024, 9, 9)], "b2") and now() == [("f1", 2, 20), ("f2", 1, 3)]
    # rows written without a commit are not seen
    spark.createDataFrame([("f2", 2024, 1, 99)], cols).withColumn("batch", F.lit("lost")) \
        .write.partitionBy("batch", "year", "month").mode("append").parquet(path + "/data")
    assert now() == [("f1", 2, 20), ("f2", 1, 3)]
    assert commit([], "b3", sources=["f2"]) and now() == [("f1", 2, 20)]
    assert sinks.vacuum_sources(spark, path) == ["b1"] and now() == [("f1", 2, 20)]


def test_ledger_stream_sink_runs_epochs_once(spark, tmp_dir):
    src, path = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    cols = "source_file string, year int, month int, v int"
    spark.createDataFrame([("f1", 2024, 1, 1)], cols).write.parquet(src)
    stream = spark.readStream.schema(cols).parquet(src)
    sinks.start_ledger_sink(stream, path, os.path.join(tmp_dir, "ck"), "q", available_now=True).awaitTermination()
    # the same epoch again, as after a lost checkpoint
    sinks.start_ledger_sink(stream, path, os.path.join(tmp_dir, "ck2"), "q", available_now=True).awaitTermination()
    assert [r["v"] for r in sinks.read_committed(spark, path).collect()] == [1]


def test_scores_merge_once_and_null_safe(spark):
    ev = spark.createDataFrame([(None, T0, 1.0), ("a", None, 2.0), ("a", T0, 3.0)], "asset string, ts timestamp, x double")
    scores = spark.createDataFrame([(None, T0, 0.4), ("a", None, 0.5), ("a", T0, 0.6), ("a", T0, 0.9), ("a", T0, None)],
                                   "asset string, ts timestamp, anomaly_score double")
    got = {(r["asset"], r["ts"], r["value"]) for r in AL.readings_long(ev, "asset", "ts", ["x"], scores, ["anomaly_score"])
           .filter("sensor_name = 'anomaly_score'").collect()}
    assert got == {(None, T0, 0.4), ("a", None, 0.5), ("a", T0, 0.9)}


def test_change_log_latest_wins(spark):
    base = spark.createDataFrame([("r1", 1.0, True), ("r2", 2.0, True), ("r3", 3.0, True)],
                                 "rule_id string, warning_threshold double, enabled boolean")
    log = spark.createDataFrame(
        [("r1", T0, 2, None, False, None), ("r1", T0, 1, 9.0, True, None), ("r1", None, 5, 7.0, True, None),
         ("r2", T0, 1, None, None, True), ("new", T0, 1, 4.0, True, False), ("unborn", T0, 1, 4.0, True, True)],
        "rule_id string, at timestamp, number int, warning_threshold double, enabled boolean, deleted boolean")
    got = {tuple(r) for r in AL.apply_changes(base, log, "rule_id", ["at", "number"]).collect()}
    assert got == {("r1", 1.0, False), ("r3", 3.0, True), ("new", 4.0, True)}


def test_ordered_positions_of_any_type(spark):
    from telemetra.operators import sequence as seq
    names = [None, "", "b", "a", "é", "a", "B"]
    df = spark.createDataFrame([(g, n) for g in (None, 1) for n in names], "g int, name string").repartition(4)
    order = sorted(names, key=lambda n: (n is not None, (n or "").encode()))
    for group, size in (("g", 7), (None, 14)):
        rows = seq.ordered_positions(df, ["name"], group).collect()
        assert {r[seq.CNT] for r in rows} == {size}
        for g in ([None, 1] if group else ["all"]):
            own = sorted((r[seq.RN], r["name"]) for r in rows if g == "all" or r["g"] == g)
            assert [k for k, _ in own] == list(range(1, size + 1))
            assert [n for _, n in own] == (order if group else [n for n in order for _ in range(2)])
