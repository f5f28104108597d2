"""Findings of round 3 on the operators in ``llm``."""

import random

import pyarrow as pa
import pytest

from telemetra.llm import bpe, common, lm_score
from tests.llm.conftest import frame
from tests.llm.test_lm_score import few_words, got, of, plain_scores


@pytest.fixture(scope="module")
def codec():
    tokens = [bytes([i]) for i in range(256)] + [b"ab", b" ab"]
    return bpe.Codec(tokens, bpe.PerfectHash(tokens), r" ?\w+|\s+|[^\s\w]+")


def test_tokens_are_passed_on_in_small_batches(codec, monkeypatch):
    """A task never holds the ids of a whole batch of texts."""
    monkeypatch.setattr(bpe, "BATCH_IDS", 10)
    texts = ["ab ab", None, "xyz", "", "q" * 30, "ab", "x y z", "éé", "abab ab" * 3, ""]
    whole = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    encoded = [*bpe.encoded_batches(codec, whole)]
    assert all(len(b.column(1).values) <= 10 or b.num_rows == 1 for b in encoded) and len(encoded) > 3
    rows = pa.Table.from_batches(encoded).to_pylist()
    assert [r["id"] for r in rows] == [*range(len(texts))]
    assert [r["ids"] for r in rows] == [codec.encode(t or "") for t in texts]

    lists = pa.array([r["ids"] if r["id"] != 3 else None for r in rows], pa.list_(pa.int32()))
    given = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), lists], ["id", "ids"])
    for part in (given, given.slice(2)):
        decoded = [*bpe.decoded_batches(codec, part)]
        assert all(sum(map(len, filter(None, b.column(1).to_pylist()))) <= 10 or b.num_rows == 1 for b in decoded)
        out = pa.Table.from_batches(decoded).to_pylist()
        assert [r["decoded"].decode() for r in out] == [texts[r["id"]] or "" for r in part.to_pylist()]
        assert [r["ids"] for r in out] == [r["ids"] for r in part.to_pylist()]


def test_texts_are_worked_on_few_at_a_time(monkeypatch):
    monkeypatch.setattr(common, "SLICE_ROWS", 4)
    whole = pa.RecordBatch.from_arrays([pa.array(range(10))], ["id"])
    parts = [*common.slices([whole, whole.slice(0, 0), whole.slice(8)])]
    assert [p.num_rows for p in parts] == [4, 4, 2, 2]
    assert pa.Table.from_batches(parts).to_pydict()["id"] == [*range(10), 8, 9]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_of_many_blocks_and_long_repeated_ids(spark, monkeypatch, order):
    """Blocks of few words; the rows of repeated ids with more words than a block are spread over blocks."""
    monkeypatch.setattr(lm_score, "BLOCK_WORDS", 25)
    monkeypatch.setattr(lm_score, "LEAST_PARTS", 5)
    rows = few_words(order, 40)
    rng = random.Random(order)
    rows += [(7, " ".join(rng.choices("abcdexyz", k=20))) for _ in range(12)]
    df = frame(spark, of(rows)).repartition(3)
    assert got(lm_score.stupid_backoff(df, order=order)) == plain_scores(rows, order)


def test_scoring_writes_little(spark, monkeypatch):
    """What is written stays near the size of the texts, and n-grams are sent once for a block."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(5000)]
    texts = [" ".join(rng.choices(vocabulary, k=300)) for _ in range(150)]
    rows = [(i, texts[i % 150]) for i in range(300)]
    size = []

    def stored(df, name):
        out = common.stored(df, name)
        size.append(common.stored_bytes(out))
        return out
    monkeypatch.setattr(lm_score, "stored", stored)
    out = lm_score.stupid_backoff(frame(spark, of(rows)).repartition(2))
    assert sum(size) < 1.5 * sum(len(t) for _, t in rows)
    assert got(out) == plain_scores(rows, 3)
