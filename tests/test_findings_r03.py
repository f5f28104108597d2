"""Findings of round 3: plans that grow with the input only, with the same results."""

from __future__ import annotations

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from telemetra.operators import alerts as AL
from telemetra.operators import anomaly as AN
from telemetra.operators import clean as C
from telemetra.operators import features as FT
from telemetra.operators import sequence as seq
from telemetra.operators import stats as ST
from telemetra.plans import queries_checks as Q
from telemetra.plans.queries_checks import same_rows
from telemetra.profile import SensorProfile

P = SensorProfile(asset="a", ts="t", sensors=("x", "y"), tiebreak=("i",), limits={"x": (0.0, 90.0)}, block_rows=50,
                  chunk_seconds=1024 * 60)


def _readings(spark, n=400):
    rng = np.random.default_rng(5)
    rows = [(None if i % 3 == 0 else i % 2, i, None if i % 7 == 0 else float(rng.integers(0, 100)),
             float(rng.integers(0, 9)), i) for i in range(n)]
    return spark.createDataFrame(rows, "a long, s long, x double, y double, i long") \
        .withColumn("t", F.timestamp_seconds(F.col("s") * 60)).drop("s")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sliding_aggregates_take_one_sort(spark):
    """they took a sort per frame length and direction, of rows that grew with every aggregate."""
    frame = seq.sequence_frame(_readings(spark), P, 20)
    specs = [(f"{s}_{k}_{w}", s, w, k) for s in P.sensors for w in (3, 20) for k in ("mean", "std", "min", "max")]
    sorts = [_plan(df).count("Sort [") for df in (frame, seq.sliding_aggs(frame, P, specs))]
    assert sorts[1] == sorts[0] + 1


def test_sliding_aggregates_with_nulls_and_nan(spark):
    """A NaN is in the frames that hold it and in no other; whole numbers stay exact."""
    big = 2 ** 60
    x = [None, 1.0, math.nan, 2.0, 2.0, 2.0, None, 7.0, 1.0, None, None, None, 4.0]
    df = spark.createDataFrame([(1, i, v, big + i % 3, i) for i, v in enumerate(x)], "a long, s long, x double, y long, i long") \
        .withColumn("t", F.timestamp_seconds("s"))
    frame = seq.sequence_frame(df, P, 2)
    got = seq.sliding_aggs(frame, P, [("m", "x", 2, "mean"), ("sd", "x", 2, "std"), ("lo", "x", 2, "min"),
                                      ("hi", "x", 2, "max"), ("top", "y", 2, "max")])
    rows = sorted((r.asDict() for r in seq.drop_halo(got).collect()), key=lambda r: r["i"])
    same = lambda p, q: p is q is None or (p is not None and q is not None and (
        math.isnan(p) and math.isnan(q) or math.isclose(p, q, rel_tol=1e-12)))
    for i, r in enumerate(rows):
        have = [v for v in x[max(i - 2, 0):i + 1] if v is not None]
        real = [v for v in have if not math.isnan(v)]
        assert same(r["m"], float(np.mean(have)) if have else None), i
        assert same(r["sd"], float(np.std(have, ddof=1)) if len(have) > 1 else None), i
        assert same(r["lo"], min(real) if real else (math.nan if have else None)), i
        assert same(r["hi"], (math.nan if len(real) < len(have) else max(have)) if have else None), i
        assert r["top"] == max(big + j % 3 for j in range(max(i - 2, 0), i + 1))


def test_silver_features_take_one_pass(spark):
    """F1: z-scores took passes of their own, over rows that had the rolling columns already."""
    df = _readings(spark)
    out = FT.silver_features(C.clean_readings(df, P, keep_sequence=True), P, windows=(3, 20), lookback=30)
    assert _plan(out).count("FlatMapGroupsInArrow") == 1


def test_clean_rows_are_numbered_from_a_written_table(spark):
    """the rows of the blocks were counted by running all of the cleaning again."""
    df = _readings(spark)
    clean = C.clean_readings(df, P, keep_sequence=True)
    assert "min(struct" not in _plan(clean) and "FileScan" not in _plan(df)
    direct = C.clean_readings(df, P, strategy="direct", keep_sequence=True)
    cols = direct.columns
    assert sorted(map(str, clean.select(cols).collect())) == sorted(map(str, direct.collect()))


def test_clean_readings_carries_named_columns(spark):
    df = _readings(spark)
    wide = C.clean_readings(df, P, keep_sequence=True)
    for strategy in ("chunked", "direct"):
        slim = C.clean_readings(df, P, strategy=strategy, keep_sequence=True, carry=("i",))
        assert set(slim.columns) == {"a", "t", "x", "y", "i", seq.RN, seq.CNT}
        assert sorted(map(str, slim.select(*wide.columns).collect())) == sorted(map(str, wide.collect()))
        assert set(C.clean_readings(df, P, strategy=strategy, carry=()).columns) == {"a", "t", "x", "y"}


def _walked(model, row) -> float:
    """Mean path of one row, tree by tree."""
    out = []
    for _, tree in model.nodes.groupby("tree_id"):
        nodes, at, depth = tree.set_index("node_id"), 0, 0
        while nodes.loc[at, "feature"] >= 0:
            left = row[int(nodes.loc[at, "feature"])] < nodes.loc[at, "threshold"]
            at, depth = int(nodes.loc[at, "left" if left else "right"]), depth + 1
        out.append(depth + AN._c(float(nodes.loc[at, "size"])))
    return float(np.mean(out))


def test_forest_walk_is_that_of_single_rows(spark):
    """All trees are walked for a few rows at a time, in a fixed number of steps."""
    rng = np.random.default_rng(1)
    data = pd.DataFrame({"id": range(600), "a": rng.normal(size=600), "b": rng.normal(size=600)})
    df = spark.createDataFrame(data).withColumn("note", F.lit(None).cast("string"))
    model = AN.train_iforest(df, ["a", "b"], n_trees=7, max_samples=32, contamination=0.1, seed=2, key_cols=["id"])
    scored = AN.score_iforest(df, model, normalise=None)
    assert scored.columns == ["id", "a", "b", "note", "score_samples", "raw_score", "is_anomaly"]
    rows = scored.orderBy("id").collect()
    assert len(rows) == 600 and sum(r["is_anomaly"] for r in rows) == 60
    for r in rows[::60]:
        z = [(r[c] - m) / s for c, m, s in zip("ab", model.means, model.stds)]
        assert r["score_samples"] == pytest.approx(-2.0 ** (-_walked(model, z) / AN._c(32)), rel=1e-12)
    assert len(AN._mean_paths(np.array([[math.nan, 0.0]]), model.arrays())) == 1


def test_forest_scores_its_training_rows_once(spark, tmp_dir, monkeypatch):
    """The quantile of the scores ran the forest once per digit."""
    calls = []
    plain = AN.exact_quantiles
    monkeypatch.setattr(AN, "exact_quantiles", lambda df, *a, **k: calls.append(_plan(df)) or plain(df, *a, **k))
    df = spark.range(300).select(F.col("id"), F.rand(3).alias("a"))
    AN.train_iforest(df, ["a"], n_trees=5, max_samples=16, contamination=0.1, key_cols=["id"])
    assert len(calls) == 1 and "InArrow" not in calls[0] and "InPandas" not in calls[0]


@pytest.mark.parametrize("sorted_to", [0, 10, 10_000])
def test_quantiles_of_small_and_large_groups(spark, monkeypatch, sorted_to):
    """groups that a task can order are ordered once; others go by digits; both give the same."""
    monkeypatch.setattr(ST, "GROUP_SORTED", sorted_to)
    rng = np.random.default_rng(2)
    groups = {None: 5, "one": 1, "few": 9, "many": 400}
    rows = [(g, "s", None if i == 7 else float(rng.integers(0, 40)) / 4) for g, n in groups.items() for i in range(n)]
    rows += [("void", "s", None), ("nan", "s", 1.0), ("nan", "s", math.nan), ("zero", "s", -0.0), ("zero", "s", 0.0)]
    df = spark.createDataFrame(rows, "g string, k string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {(r["g"], r["p"]): r["q"] for r in ST.exact_quantiles(df, ["g", "k"], "v", probs).collect()}
    want = {}
    for g in {r[0] for r in rows} - {"void", "nan"}:
        have = [v for h, _, v in rows if h == g and v is not None]
        want |= {(g, p): float(np.quantile(have, p)) for p in probs}
    assert {k: v for k, v in got.items() if k[0] != "nan"} == want
    assert got["nan", 0.0] == 1.0 and math.isnan(got["nan", 1.0]) and len(got) == len(want) + len(probs)


def test_quantiles_of_small_groups_shuffle_no_histograms(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    x = df.select("g", F.col("v").alias("_v"))
    assert _plan(ST._quantiles_by_sort(x, ["g"], [0.5])).count("Sort [") == 1


def test_same_rows(spark):
    """two forecasts are compared in one pass over both."""
    df = spark.createDataFrame([(1, None), (1, None), (2, 0.5)], "a int, b double")
    assert same_rows(df, df)
    assert not same_rows(df, df.distinct())
    assert not same_rows(df, df.fillna(0.0))
    assert not same_rows(df.limit(0), df.limit(0))


def test_rules_then_cooldown_folds_narrow_events(spark, tmp_dir, monkeypatch):
    """the fold carried every column of the alerts through its shuffles."""
    rng = np.random.default_rng(8)
    n = 300
    pd.DataFrame({
        "l_orderkey": np.arange(n), "l_linenumber": 1, "l_partkey": 1, "l_suppkey": np.arange(n) % 3,
        "l_quantity": rng.uniform(1, 50, n).round(), "l_extendedprice": rng.uniform(1e3, 1e5, n), "l_discount": 0.1,
        "l_tax": 0.08, "l_returnflag": "R",
        "l_shipdate": pd.Timestamp("1999-01-01") + pd.to_timedelta(rng.integers(0, 200, n), "D")}) \
        .astype({"l_shipdate": "datetime64[us]"}).to_parquet(os.path.join(tmp_dir, "lineitem.parquet"))
    given = []
    plain = AL.apply_cooldown
    monkeypatch.setattr(AL, "apply_cooldown", lambda ev, *a, **k: given.append(ev) or plain(ev, *a, **k))
    fired = Q.q_rules_then_cooldown(spark, tmp_dir)
    assert given[0].columns == ["rule_id", "l_suppkey", "l_shipdate"]
    ev = Q._li_events(spark, tmp_dir)[0]
    whole = plain(ev, "l_shipdate", ["l_suppkey", "rule_id"], cooldown_col=None, cooldown_minutes=43200)
    want = sorted(map(tuple, whole.select("rule_id", "l_suppkey", "l_shipdate").collect()))
    assert want and sorted(map(tuple, fired.collect())) == want
