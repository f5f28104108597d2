"""Distributed statistics equal brute force (NumPy) on seeded tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetra.operators import anomaly as AN
from telemetra.operators import drift as DR
from telemetra.operators import stats as ST


def table(spark, seed=3, n=2000, groups=3):
    rng = np.random.default_rng(seed)
    g = rng.integers(0, groups, n)
    v = np.round(rng.normal(50, 10, n), 1)  # rounding creates ties
    v[::97] = np.nan
    rows = [(int(a), None if np.isnan(b) else float(b)) for a, b in zip(g, v)]
    return spark.createDataFrame(rows, "g int, v double"), g, v


#: Digits as they are, and digits so small that every combination of them is used.
DIGITS = [(42, 21), (50, 47), (3, 1)]


@pytest.fixture(params=DIGITS)
def digits(request, monkeypatch):
    monkeypatch.setattr(ST, "HIGH", request.param[0])
    monkeypatch.setattr(ST, "MIDDLE", request.param[1])


def test_exact_quantiles(spark, digits):
    df, g, v = table(spark)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {(r["g"], r["p"]): r["q"] for r in ST.exact_quantiles(df, ["g"], "v", probs).collect()}
    for k in range(3):
        vals = v[(g == k) & ~np.isnan(v)]
        for p in probs:
            assert got[(k, p)] == pytest.approx(np.quantile(vals, p), abs=1e-9)
    whole = {r["p"]: r["q"] for r in ST.exact_quantiles(df, [], "v", probs).collect()}
    assert whole == {p: pytest.approx(np.quantile(v[~np.isnan(v)], p), abs=1e-9) for p in probs}


def test_quantiles_of_far_values_and_null_groups(spark):
    """One value far off, both signs, zeros of both signs, a null group, a group without values."""
    values = [-1e300, -2.0, -0.0, 0.0, 0.0, 1e-300, 1.0, 1.0000000000000002, 1e12]
    rows = [(g, x) for g in (None, 1) for x in values] + [(2, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.1, 0.3, 0.5, 0.8, 1.0]
    got = {(r["g"], r["p"]): r["q"] for r in ST.exact_quantiles(df, ["g"], "v", probs).collect()}
    assert got == {(g, p): pytest.approx(np.quantile(values, p)) for g in (None, 1) for p in probs}


def test_quantiles_start_no_job(spark):
    """One plan at every size: nothing runs while the query is built."""
    tracker = spark.sparkContext.statusTracker()
    df, _, _ = table(spark)
    spark.sparkContext.setJobGroup("build", "build")
    try:
        ST.exact_quantiles(df, ["g"], "v", [0.5])
        ST.value_running_counts(df.withColumn("w", F.lit(1)), ["g"], "v", ["w"])
        assert list(tracker.getJobIdsForGroup("build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ordered_bits(spark):
    import random
    import struct

    from telemetra.functions.ordered import with_ordered_bits
    rng = random.Random(1)
    xs = [0.0, -0.0, float("inf"), float("-inf"), 5e-324, 2.225073858507201e-308, 1.7976931348623157e308]
    xs += [struct.unpack("d", struct.pack("q", rng.getrandbits(63)))[0] for _ in range(2000)]
    xs += [y for e in range(-1074, 1024) for y in (2.0 ** e, np.nextafter(2.0 ** e, 0), -np.nextafter(2.0 ** e, 2))]
    df = spark.createDataFrame([(float(x),) for x in xs if x == x], "x double")
    for r in with_ordered_bits(df, "x", "k").collect():
        size = struct.unpack("q", struct.pack("d", abs(r["x"])))[0]
        assert r["k"] == (-size if r["x"] < 0 else size)


def test_quantile_single_value_and_constant(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (2, 7.0), (2, 7.0)], "g int, v double")
    got = {(r["g"], r["p"]): r["q"] for r in ST.exact_quantiles(df, ["g"], "v", [0.25, 0.9]).collect()}
    assert got == {(1, 0.25): 5.0, (1, 0.9): 5.0, (2, 0.25): 7.0, (2, 0.9): 7.0}


def ks_brute(a, b):
    allv = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), allv, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), allv, side="right") / len(b)
    return np.max(np.abs(fa - fb))


def test_value_running_counts(spark, digits):
    df, g, v = table(spark)
    x = df.withColumn("w", F.lit(1))
    got = {(r["g"], r["v"]): r["cum_w"] for r in ST.value_running_counts(x, ["g"], "v", ["w"]).collect()}
    for (k, val), cum in got.items():
        vals = v[(g == k) & ~np.isnan(v)]
        assert cum == int(np.sum(vals <= val))


def test_ks_and_psi_brute_force(spark):
    rng = np.random.default_rng(7)
    a = np.round(rng.normal(0, 1, 700), 2)
    b = np.round(rng.normal(0.3, 1.2, 400), 2)
    base = spark.createDataFrame([("f", float(x)) for x in a], "feature string, value double")
    cur = spark.createDataFrame([("f", float(x)) for x in b], "feature string, value double")
    ks = DR.ks_test(base, cur).first()
    assert ks["ks_statistic"] == pytest.approx(ks_brute(a, b), abs=1e-12)
    lo, hi = min(a.min(), b.min()), max(a.max(), b.max())
    edges = np.linspace(lo, hi, 11)
    hb = np.clip(np.histogram(a, edges)[0] / len(a), 1e-6, None)
    hc = np.clip(np.histogram(b, edges)[0] / len(b), 1e-6, None)
    want = np.sum((hc - hb) * np.log(hc / hb))
    assert DR.psi(base, cur).first()["psi"] == pytest.approx(want, rel=1e-9)


def test_ks_pvalue_regimes(spark):
    df = spark.createDataFrame([(0.3,), (0.9,), (1.18,), (2.0,)], "lam double")
    got = [r["q"] for r in df.select(DR.kolmogorov_sf(F.col("lam")).alias("q")).collect()]
    # brute force: the alternating series with many terms
    want = [2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * lam * lam) for k in range(1, 400))
            for lam in (0.3, 0.9, 1.18, 2.0)]
    assert got == pytest.approx(want, abs=1e-9)


def test_drift_verdicts(spark):
    rng = np.random.default_rng(1)
    base = spark.createDataFrame([(float(x), float(y), 1.0) for x, y in
                                  zip(rng.normal(0, 1, 500), rng.normal(0, 1, 500))],
                                 "a double, b double, c double")
    cur = spark.createDataFrame([(float(x), float(y), 1.0) for x, y in
                                 zip(rng.normal(0, 1, 300), rng.normal(3, 1, 300))],
                                "a double, b double, c double")
    rep = {r["feature"]: r for r in DR.drift_report(base, cur, ["a", "b", "c"]).collect()}
    assert rep["b"]["is_drifted"] and not rep["c"]["is_drifted"]
    assert rep["c"]["psi"] == 0.0
    assert rep["a"]["overall_status"] == "DRIFT_DETECTED"
    few = DR.drift_report(base, cur.limit(9), ["a"]).collect()
    assert few == []  # fewer than 10 current values: skipped


def test_auc_exact(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 500)
    s = np.round(rng.random(500) + 0.3 * y, 2)
    df = spark.createDataFrame([(int(a), float(b), bool(b > 0.6)) for a, b in zip(y, s)],
                               "y int, s double, p boolean")
    got = AN.evaluate_anomaly(df, "y", "p", "s").first()["auc_roc"]
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg])
    assert got == pytest.approx(want, abs=1e-12)
    one = spark.createDataFrame([(1, 0.3, True)], "y int, s double, p boolean")
    assert AN.evaluate_anomaly(one, "y", "p", "s").first()["auc_roc"] == 0.0


def test_correlation_undefined(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    r = ST.sensor_correlation(df, [("a", "b")]).first()
    assert r["pearson_r"] == 0.0 and r["interpretation"] is None


def test_tags(spark):
    df = spark.createDataFrame([("x; y;;z ",), ("y",), ("",), (None,)], "t string")
    counts = {r["tag"]: r["count"] for r in ST.tag_counts(df, "t").collect()}
    assert counts == {"x": 1, "y": 2, "z": 1}
    per = {r["selections"]: r["rows"] for r in ST.tags_per_row(df, "t").collect()}
    assert per == {3: 1, 1: 1}


def test_fault_analysis_edges(spark):
    df = spark.createDataFrame([(1.0, 1), (3.0, 1), (2.0, 0)], "a double, fault int")
    rank, ov = ST.fault_analysis(df, ["a"], "fault")
    r = rank.first()
    # one normal row -> std 1; z = |2 - 2| / 1 = 0
    assert (r["fault_mean"], r["normal_mean"], r["z_difference"]) == (2.0, 2.0, 0.0)
    assert ov.first()["fault_rate"] == pytest.approx(0.6667)
