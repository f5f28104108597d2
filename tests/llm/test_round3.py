"""Substring dedup by doubling, hard negatives and the prefix trie against plain brute-force versions."""

import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from telemetra.llm import queries as Q

VECTORS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())),
                      StructField("label", IntegerType())])
TURNS = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()),
                    StructField("role", StringType()), StructField("text", StringType())])


def plain_rows(df):
    return collections.Counter(tuple(r[c] for c in df.columns) for r in df.collect())


# substring dedup

def plain_substrings(rows, length):
    """Counter of (id, words, removed, kept words): every window, by a dictionary."""
    def order(i):
        return (i is None, i or 0)

    first = {}
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in texts:
        for p in range(len(w) - length + 1):
            k = tuple(w[p:p + length])
            first[k] = min(first.get(k, order(i)), order(i))
    out = collections.Counter()
    for i, w in texts:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p:p + length])] < order(i):
                gone[p:p + length] = [True] * length
        out[(i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())] += 1
    return out


def test_op11_query(spark, table, rows):
    want = collections.Counter()
    for (i, n, removed, kept), times in plain_substrings([r[:2] for r in rows], 50).items():
        want[(i, n, removed, hashlib.sha256(kept.encode()).hexdigest())] += times
    assert plain_rows(Q.op11_substring_doubling(spark, table)) == want
    assert sum(k[2] for k in want) > 0


@pytest.mark.parametrize("length", [3, 16, 17, 50, 90])
def test_op11_lengths_ids_and_periods(spark, length):
    """Few words, periods, copies inside one text, repeated and null ids, a very long text."""
    from telemetra.llm.substring_dedup import remove_repeated
    rng = random.Random(length)
    few = ["a", "b", "ab", "é", "漢"]
    base = [rng.choice(few) for _ in range(400)]
    rows = [(7, " ".join(base)), (7, " ".join(base[100:])), (7, " ".join(base)), (3, " ".join(base[50:200])),
            (None, "\t".join(base)), (None, " ".join(base[:120]) + " end"), (9, "a " * 300), (4, "a " * 130),
            (5, None), (6, ""), (8, " \n "), (2, " ".join(base[:length])), (1, " ".join(base[: length - 1])),
            (-5, "x y " * 60), (12, "x y " * 61)]
    for i in range(20, 40):
        at = rng.randrange(300)
        rows.append((i, " ".join([rng.choice(few) for _ in range(30)] + base[at:at + rng.randint(1, 120)]
                                 + [rng.choice(few) for _ in range(30)])))
    long = [str(rng.randrange(10 ** 6)) for _ in range(60_000)]
    rows += [(50, " ".join(long)), (51, " ".join(long[30_000:] + long[:30_000]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"])
                              for r in remove_repeated(df, length=length).collect())
    assert got == plain_substrings(rows, length)


def test_op11_places_beyond_the_broadcast_bound(spark, table, monkeypatch):
    from telemetra.llm import substring_dedup
    want = plain_rows(Q.op11_substring_doubling(spark, table))
    monkeypatch.setattr(substring_dedup, "BROADCAST_BYTES", 0)
    assert plain_rows(Q.op11_substring_doubling(spark, table)) == want


def test_op11_levels():
    from telemetra.llm.substring_dedup import levels
    assert levels(50) == [13, 25, 50] and levels(10) == [10]
    assert all(2 * a >= b for a, b in zip(levels(999), levels(999)[1:]))


# hard negatives

def test_op12_residue_product_is_exact():
    from telemetra.llm.hard_negatives import moduli, rns_product
    rng = np.random.default_rng(5)
    for size, width in [(3, 1), (200, 64), (30_000, 2500), (1 << 23, 100), (1 << 24, 0)]:
        a = rng.integers(-size, size + 1, (7, width))
        b = rng.integers(-size, size + 1, (9, width + 3))
        bound = size * size * max(width, 1)
        primes = moduli(bound)
        assert math.prod(primes) > 2 * bound and all(p < 256 for p in primes)
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert rns_product(a, b, primes).tolist() == want
    extreme = np.full((2, 3000), 4000)
    assert rns_product(extreme, -extreme, moduli(3000 * 4000 ** 2)).tolist() == [[-3000 * 4000 ** 2] * 2] * 2


def make_vectors(ids_unique):
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0.1, 0.4) for _ in range(12)], rng.randrange(3)) for i in range(220)]
    rows += [(i, [0.5] * 12, i % 2) for i in range(300, 360)]  # ties
    rows += [(400, None, 1), (401, [None] + [0.1] * 11, 1), (402, [float("nan")] * 12, 1),
             (403, [float("inf")] + [0.0] * 11, 1), (404, [0.3] * 12, None), (450, [0.4] * 12, 9)]
    if not ids_unique:
        rows += [(None, [0.6] * 12, 0), (None, [0.6] * 12, 1), (-50, [0.2] * 12, 2), (500, [0.1], 0), (550, [], 1),
                 rows[50], rows[50], rows[60], (100, [3.0] * 12, 2)]
    return rows


def plain_negatives(rows):
    def key(score_row):
        score, (i, at) = score_row
        return (-score, i is None, i or 0, at)

    part = []
    for at, (i, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            if i is not None and i % 7 == 0:
                label = (label + 1) % 10
            part.append((i, at, [math.floor(256 * x) for x in v], label))
    out = collections.Counter()
    for i, at, q, label in part:
        if i is None or i % 50:
            continue
        scored = sorted(((sum(a * b for a, b in zip(q, r)), (j, k), other == label)
                         for j, k, r, other in part if k != at), key=lambda s: key(s[:2]))
        for score, (j, k), same in [s for s in scored if s[2]][:5]:
            inside = [s for s in scored if not s[2] and 50 * score <= 100 * s[0] <= 95 * score][:3]
            for rank, (negative, (n, _), _) in enumerate(inside, 1):
                out[(i, j, rank, n, score, negative)] += 1
    return out


@pytest.mark.parametrize("blocks", [(4096, 512), (16, 3)])
def test_op12_query(spark, tmp_path, monkeypatch, blocks):
    from telemetra.llm import hard_negatives
    monkeypatch.setattr(hard_negatives, "ROWS", blocks[0])
    monkeypatch.setattr(hard_negatives, "ANCHORS", blocks[1])
    rows = make_vectors(False)
    spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("clash") for c in ("row", "id", "q", "score", "salt")}) \
        .repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = plain_rows(Q.op12_hard_negatives(spark, str(tmp_path)))
    want = plain_negatives(rows)
    # equal rows of one null id, or of one id, are told apart by their place only: compare without it
    assert got == want and len(want) > 20


def test_op12_scores_too_large(spark, tmp_path):
    spark.createDataFrame([(0, [1e9] * 4, 1), (1, [1e9] * 4, 1)], VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    with pytest.raises(ValueError):
        Q.op12_hard_negatives(spark, str(tmp_path))


# prefix trie

def make_turns():
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 40), *range(100, 140), 205, 299, -7, -100, -101, 10 ** 12, 10 ** 12 + 1]:
        for t in range(rng.choice([1, 2, 3, 4, 7, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "hello 漢😀", "", "x" * 40])))
    rows += [(60, t, "user", "same") for t in range(37)] + [(61, t, "user", "same") for t in range(64)]
    rows += [(62, None, "user", "null turn first"), (62, 0, None, None), (62, 0, None, None), (62, 0, "a", "tie"),
             (63, 5, "u", "late"), (63, -1, "u", "early"), (None, 0, "user", "nobody"), (None, None, None, None)]
    rows += [(c, t, "user", "copy") for c in range(70, 99) for t in range(8)]
    return rows


def plain_trie(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100)) if abs(c) < 2 ** 53 else c - c % 100
        seqs[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    out = collections.Counter()
    for k, m in members.items():
        below = [x for x in members if x[:len(k)] == k]
        out[(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k],
             sum(not children[x] for x in below),
             sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
             hashlib.sha256(",".join(map(str, sorted(c for c in m if seqs[c] == k))).encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("clashing", [False, True])
def test_op13_query(spark, tmp_path, clashing):
    rows = make_turns()
    df = spark.createDataFrame(rows, TURNS)
    if clashing:
        df = df.withColumns({c: F.lit("clash") for c in ("conv", "pos", "u", "k", "w", "len", "part", "n")})
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    assert plain_rows(Q.op13_prefix_trie(spark, str(tmp_path))) == plain_trie(rows)


def test_op13_sums_need_no_common_depth(spark, tmp_path):
    """One turnless conversation beside others; a trie of one node."""
    turnless = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(turnless, 0, "u", "gone")]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = plain_rows(Q.op13_prefix_trie(spark, str(tmp_path)))
    assert got == plain_trie(rows) and len(got) == 1


# empty tables, SQL

@pytest.mark.parametrize("name, table, schema", [("op12_hard_negatives", "embeddings", VECTORS),
                                                 ("op13_prefix_trie", "conversations", TURNS)])
def test_empty_tables(spark, tmp_path, name, table, schema):
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    got = Q.QUERIES[name](spark, str(tmp_path))
    assert got.count() == 0 and got.columns


@pytest.mark.parametrize("name, table, schema", [("op12_hard_negatives", "embeddings", VECTORS),
                                                 ("op13_prefix_trie", "conversations", TURNS)])
def test_sql(spark, tmp_path, name, table, schema):
    rows = make_vectors(True) if table == "embeddings" else make_turns()
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    want = con.execute(Q.ORACLES[name])
    columns = [d[0] for d in want.description]
    got = Q.QUERIES[name](spark, str(tmp_path))
    assert plain_rows(got.select(*columns)) == collections.Counter(want.fetchall())
