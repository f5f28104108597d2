"""Alert evaluation and the distributed greedy cooldown vs brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from telemetra.operators import alerts as AL

T0 = dt.datetime(2025, 1, 1)


def greedy(events, cooldown_s):
    fired, last = {}, {}
    for key, ts, eid in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        lt = last.get(key)
        if lt is None or (ts - lt).total_seconds() >= cooldown_s:
            last[key] = ts
            fired.setdefault(key, []).append(eid)
    return sorted(e for v in fired.values() for e in v)


@pytest.mark.parametrize("seed,minutes", [(1, 15), (2, 60), (3, 1)])
def test_cooldown_matches_greedy(spark, seed, minutes):
    rng = random.Random(seed)
    events = []
    for i in range(600):
        key = rng.choice(["a", "b", "c"]) if i % 7 else "hot"
        ts = T0 + dt.timedelta(seconds=rng.randint(0, 6 * 3600))
        events.append((key, ts, f"e{i:04d}"))
    df = spark.createDataFrame(events, "k string, ts timestamp, alert_id string")
    got = sorted(r["alert_id"] for r in AL.apply_cooldown(
        df, "ts", ["k"], cooldown_col=None, cooldown_minutes=minutes).collect())
    assert got == greedy(events, minutes * 60)


def test_cooldown_edges(spark):
    L = 15 * 60
    ev = [("r", T0, "a"), ("r", T0 + dt.timedelta(seconds=L - 1), "b"),
          ("r", T0 + dt.timedelta(seconds=L), "c"), ("r", T0 + dt.timedelta(seconds=2 * L - 1), "d"),
          ("r", T0 + dt.timedelta(seconds=2 * L), "e"), ("r", T0 + dt.timedelta(seconds=2 * L), "f")]
    df = spark.createDataFrame(ev, "k string, ts timestamp, alert_id string")
    got = sorted(r["alert_id"] for r in AL.apply_cooldown(
        df, "ts", ["k"], cooldown_col=None, cooldown_minutes=15).collect())
    assert got == ["a", "c", "e"]


def test_rule_scope_shared_vs_per_asset(spark):
    ev = [("t1", "R", T0, "x1"), ("t2", "R", T0 + dt.timedelta(minutes=1), "x2")]
    df = spark.createDataFrame(ev, "asset string, rule string, ts timestamp, alert_id string")
    shared = AL.apply_cooldown(df, "ts", ["rule"], cooldown_col=None, cooldown_minutes=15)
    per = AL.apply_cooldown(df, "ts", ["asset", "rule"], cooldown_col=None, cooldown_minutes=15)
    assert shared.count() == 1 and per.count() == 2


def test_evaluate_rules_and_defaults(spark):
    rules = AL.default_rules(spark)
    assert rules.count() == 7
    rules = AL.set_enabled(rules, "VIB_HIGH", False)
    readings = spark.createDataFrame(
        [("T1", T0, 545.0, 12.0, 0.8), ("T1", T0 + dt.timedelta(hours=1), 560.0, 16.0, None)],
        "turbine_id string, timestamp timestamp, exhaust_gas_temp_c double, vibration_mm_s double, "
        "anomaly_score double")
    long_df = AL.readings_long(readings, "turbine_id", "timestamp",
                               ["exhaust_gas_temp_c", "vibration_mm_s", "anomaly_score"])
    ev = AL.evaluate_rules(long_df, rules, "turbine_id", "timestamp")
    got = sorted((r["rule_id"], r["severity"], r["threshold"]) for r in ev.collect())
    assert got == [("ANOMALY", "CRITICAL", 0.7), ("EGT_HIGH", "CRITICAL", 560.0),
                   ("EGT_HIGH", "WARNING", 540.0)]
    ids = [r["alert_id"] for r in ev.collect()]
    assert len(set(ids)) == 3


def test_scores_win_on_clash(spark):
    readings = spark.createDataFrame([("T1", T0, 0.1)], "turbine_id string, timestamp timestamp, "
                                     "anomaly_score double")
    scores = spark.createDataFrame([("T1", T0, 0.9)], "turbine_id string, timestamp timestamp, "
                                   "anomaly_score double")
    long_df = AL.readings_long(readings, "turbine_id", "timestamp", ["anomaly_score"],
                               scores=scores, score_cols=["anomaly_score"])
    assert long_df.first()["value"] == 0.9


def test_derive_alarms_strict_and_payload(spark):
    r = spark.createDataFrame([("T1", T0, 580.0, 5.1), ("T2", T0, 580.5, 5.0)],
                              "turbine_id string, timestamp timestamp, exhaust_gas_temp_c double, "
                              "vibration_mm_s double")
    al = AL.derive_alarms(r, "turbine_id", "timestamp")
    got = sorted((x["turbine_id"], x["alarm_code"], x["severity"]) for x in al.collect())
    assert got == [("T1", "ALM002", "WARNING"), ("T2", "ALM001", "CRITICAL")]
    ev = spark.createDataFrame([("id1", "T1", "vib", "HIGH", 1.23456, 1.0, "msg", T0)],
                               "alert_id string, turbine_id string, sensor_name string, severity string, "
                               "value double, threshold double, message string, timestamp timestamp")
    p = AL.alert_payload(ev).first()["payload"]
    assert '"color":"FF8C00"' in p and '"value":"1.235"' in p and "Attention" in p


def test_merge_rules(spark):
    base = AL.default_rules(spark)
    ch = AL.rules_frame(spark, [("EGT_HIGH", "exhaust_gas_temp_c", "threshold_high", 500, 520, "x"),
                               ("NEW", "rpm", "rate_of_change", 5, 10, "y")])
    m = {r["rule_id"]: r for r in AL.merge_rules(base, ch).collect()}
    assert len(m) == 8 and m["EGT_HIGH"]["warning_threshold"] == 500.0


def test_cooldown_step_functions():
    """Composed tables of any cuts equal the fold; ends pass through runs in which nothing fires."""
    import random

    import numpy as np

    from telemetra.operators import cooldown as CD

    rng = random.Random(5)
    for _ in range(300):
        wait = rng.choice([1, 3, 10, 50, 1000])
        times = np.array(sorted(rng.sample(range(400), rng.randint(1, 60))))
        cuts = sorted(rng.sample(range(1, len(times)), min(len(times) - 1, rng.randint(0, 6))))
        parts = np.split(times, cuts)
        table = CD.step_table(parts[0], wait)
        for part in parts[1:]:
            table = CD.composed(table, CD.step_table(part, wait), int(times[0]), wait)
        for entered in [CD.FREE, *range(int(times[0]), int(times[0]) + wait, max(1, wait // 20))]:
            end = entered
            for t in times.tolist():
                end = t + wait if t >= end else end
            assert int(CD.followed(*table, np.array([entered]))[0]) == end


def test_cooldown_many_segments(spark, monkeypatch):
    """Segments of a few places, groups of a few segments, one busy key, null keys; few jobs."""
    import random

    from telemetra.operators import cooldown as CD

    monkeypatch.setattr(CD, "SEGMENT", 7)
    monkeypatch.setattr(CD, "GROUP", 3)
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    rows = [(f"e{i}", rng.choice(["hot"] * 6 + ["a", None]), start + dt.timedelta(seconds=rng.randrange(20_000)))
            for i in range(900)]
    rows.append(("no time", "hot", None))
    df = spark.createDataFrame(rows, "alert_id string, k string, ts timestamp")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("cooldown", "cooldown")
    try:
        out = AL.apply_cooldown(df, "ts", ["k"], cooldown_col=None, cooldown_minutes=4)
        jobs = len(tracker.getJobIdsForGroup("cooldown"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = set()
    for k in ("hot", "a", None):
        last = None
        for ts, i in sorted((r[2], r[0]) for r in rows if r[1] == k and r[2] is not None):
            if last is None or (ts - last).total_seconds() >= 240:
                want.add(i)
                last = ts
    assert {r["alert_id"] for r in out.collect()} == want
    assert jobs <= 10  # the stages of one checkpoint, whatever the length of the chains
