"""Findings of round 4 on the operators in ``llm``."""

import pytest
from pyspark.sql import functions as F

from telemetra.llm import hard_negatives
from telemetra.llm import queries as Q
from tests.llm.test_round3 import VECTORS, make_vectors, plain_negatives, plain_rows


def test_anchors_copies_are_shuffled_and_few(spark, monkeypatch):
    """The copies of the anchors never go through the driver, and do not grow with every block of rows."""
    met = []

    def meet(anchors, blocks, n_blocks, *rest):
        met.append((anchors, blocks, rest))
        return of(anchors, blocks, n_blocks, *rest)
    of = hard_negatives._met
    monkeypatch.setattr(hard_negatives, "_met", meet)
    df = spark.createDataFrame([(i, [0.1 * (i % 5), 0.2], i % 2) for i in range(60)], VECTORS)
    hard_negatives.hard_negatives(df, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 10 == 0).count()
    assert len(met) == 2
    for anchors, blocks, rest in met:
        plan = of(anchors, blocks, 400, *rest)._jdf.queryExecution()
        assert "SortMergeJoin" in plan.executedPlan().toString() and "Broadcast" not in plan.executedPlan().toString()
        assert f"{hard_negatives.SALTS}) as int" in plan.optimizedPlan().toString()  # the salts of 400 blocks


@pytest.mark.parametrize("salts", [(1, 100), (2, 4), (64, 3)])
def test_every_block_is_met_once_however_they_are_dealt(spark, tmp_path, monkeypatch, salts):
    for name, value in zip(("ROWS", "ANCHORS", "SALTS", "SALT_BLOCKS"), (16, 3, *salts)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = make_vectors(False)
    spark.createDataFrame(rows, VECTORS).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert plain_rows(Q.op12_hard_negatives(spark, str(tmp_path))) == plain_negatives(rows)
