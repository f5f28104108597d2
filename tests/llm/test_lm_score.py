"""Stupid-backoff scores against a plain count of n-grams."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from telemetra.llm import lm_score
from tests.llm.conftest import frame


def plain_scores(rows, order):
    """(id, words, score) of every row; rows of one id are one document, a null id is known by its text."""
    docs = [((i if i is not None else ("", t or "")), i, (t or "").encode().split()) for i, t in rows]
    own, every = collections.defaultdict(collections.Counter), collections.Counter()
    for key, _, words in docs:
        padded = [None] * (order - 1) + words
        for k in range(order):
            if words:
                every[(None,) * k] += 1  # contexts of the first word, and of nothing
        for p in range(order - 1, len(padded)):
            for k in range(1, order + 1):
                own[key][tuple(padded[p - k + 1:p + 1])] += 1
    n_words = sum(len(w) for _, _, w in docs)
    for grams in own.values():
        every.update(grams)
    total, length = collections.Counter(), collections.Counter()
    for key, _, words in docs:
        length[key] += len(words)
        padded = [None] * (order - 1) + words
        for p in range(order - 1, len(padded)):
            weight = 1.0
            for k in range(order, 1, -1):
                g = tuple(padded[p - k + 1:p + 1])
                if every[g] > own[key][g]:
                    total[key] += round(1e6 * math.log10(weight * ((every[g] - own[key][g]) / every[g[:-1]])))
                    break
                weight *= lm_score.BACKOFF
            else:
                total[key] += round(1e6 * math.log10(weight * (every[(padded[p],)] / n_words)))
    return collections.Counter((i, length[key], total[key]) for key, i, _ in docs)


def got(df):
    return collections.Counter((r["doc_id"], r["n_words"], round(1e6 * r["log_score"])) for r in df.collect())


def few_words(seed, n):
    rng = random.Random(seed)
    rows = [(rng.randrange(n), " ".join(rng.choices("abcdefg", k=rng.randint(1, 30)))) for _ in range(n)]
    rows += [(None, "a b c a b"), (None, "a b c a b"), (None, "zz b c"), (None, None), (900, ""), (901, " \t\n"),
             (902, None), (903, "hot " * 3000 + "cold"), (904, "hot " * 5), rows[0], rows[0]]
    return rows


def of(rows):
    return [(i, t, None, None, 0) for i, t in rows]


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("hot", [4, lm_score.HOT])
def test_orders_repeated_ids_and_hot_words(spark, monkeypatch, order, hot):
    """Few hot n-grams are broadcast, or nearly all; both give the plain counts."""
    monkeypatch.setattr(lm_score, "HOT", hot)
    rows = few_words(order, 60)
    df = frame(spark, of(rows), clashing=True).repartition(4)
    assert got(lm_score.stupid_backoff(df, order=order)) == plain_scores(rows, order)


def test_repeated_ids_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BROADCAST_IDS", 0)
    monkeypatch.setattr(lm_score, "BATCH_ROWS", 7)
    rows = few_words(8, 40)
    assert got(lm_score.stupid_backoff(frame(spark, of(rows)))) == plain_scores(rows, 3)


def test_longer_context_wins(spark):
    rows = [(1, "x a b"), (2, "x a b"), (3, "y a c"), (4, "q a b")]
    out = {r["doc_id"]: r for r in lm_score.stupid_backoff(frame(spark, of(rows))).collect()}
    # x: 2 of 4 documents begin so, one of them another; a after x, b after x a: once elsewhere of two
    assert round(10 ** out[1]["log_score"], 5) == round(1 / 4 * 1 / 2 * 1 / 2, 5)
    # q and a after q are not known: unigrams; b after a: two elsewhere of four
    assert abs(10 ** out[4]["log_score"] - (0.16 * 1 / 12) * (0.16 * 4 / 12) * (0.4 * 2 / 4)) < 1e-7


def test_empty_table_and_order(spark):
    none = frame(spark, [])
    assert lm_score.stupid_backoff(none).collect() == []
    with pytest.raises(ValueError):
        lm_score.stupid_backoff(none, order=1)


def test_tables_hold_repeated_ngrams_and_contexts(spark):
    texts = frame(spark, of([(1, "a b a b"), (2, "a b")])).select(F.col("doc_id").alias("doc"), "text")
    one, two = lm_score.count_tables(lm_score.ngrams(texts, 2), 2, 6, 2)
    assert sorted(r["c"] for r in one.collect()) == [3, 3]
    # a at the start 2 of 2 documents; b after a 3 of 3; a after b occurs once
    assert sorted((r["c"], r["before"]) for r in two.collect()) == [(2, 2), (3, 3)]
