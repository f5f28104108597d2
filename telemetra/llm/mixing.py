"""Mixing sources to target weights by a splitting tree of block quotas (operator 8).

Each source's documents stand in a permuted order (by a seeded hash), which
makes the source a stream of words that may be read up to ``max_passes``
times.  The stream is cut into blocks of ``block_words`` words.  The target of
a source gives its quota of blocks; a tree over the output shards then splits
the quotas: every node deals its blocks to its two halves by a multivariate
hypergeometric draw, so each shard gets an exact number of blocks whose
composition is that of drawing without replacement.  A shard reads the next
unread blocks of every source, so shards are disjoint, and orders its pieces
by a hash of its own (local shuffle).

All row work is DataFrame operations.  The tree itself holds one number per
source and shard and is a parameter of the plan, drawn with a fixed seed.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.common import BLANK, stored, text_of

#: Pieces up to which they are broadcast to the texts (about 60 bytes each).
BROADCAST_PIECES = 1_000_000

WEIGHTS = (5, 2, 1)
#: A draw handles fewer than a thousand million blocks; larger inputs get larger blocks.
MOST_BLOCKS = 500_000_000
#: Documents that one bucket of the permuted order holds on average.
BUCKET_DOCS = 2_000


def n_words(text_col: str):
    return F.regexp_count(text_of(text_col), F.lit(f"[^{BLANK}]+")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = 3) -> DataFrame:
    """``src, source, source_size, n_docs, target`` from ``source, source_size, n_docs``.

    Sources by code point, null last, take the weights in turn and share the
    sum of all sizes; a target stops at ``max_passes`` times the source's size
    and the excess goes to the others by weight.  The level at which this
    settles is found directly: with sources in order of cap over weight, it is
    the first at which the next source is not capped.
    """
    everything = Window.partitionBy()
    numbered = sizes.withColumn("src", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    share = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("src") % len(weights) + 1).cast("int"))
    by_ratio = Window.orderBy("ratio", "src").rowsBetween(Window.unboundedPreceding, -1)
    levels = numbered.withColumn("weight", share.cast("double")) \
        .withColumn("cap", (F.col("source_size") * max_passes).cast("double")) \
        .withColumn("ratio", F.col("cap") / F.col("weight")) \
        .withColumn("level", (F.sum("source_size").over(everything)
                              - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0)))
                    / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0))))
    water = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")),
                     F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "src"))).over(everything)
    return levels.withColumn("water", F.coalesce(water, F.lit(0.0))).select(
        "src", "source", "source_size", "n_docs",
        F.least("cap", F.col("water") * F.col("weight")).alias("target"))


def splitting_tree(quotas: list[int], n_shards: int, seed: int) -> list[list[int]]:
    """Blocks of each source for each shard; rows are shards, columns sources.

    Column sums equal the quotas; row sums differ by at most one block a level.
    """
    rng = np.random.default_rng(seed)

    def split(own: np.ndarray, shards: int) -> list[list[int]]:
        if shards == 1:
            return [own.tolist()]
        left = shards // 2
        taken = rng.multivariate_hypergeometric(own, int(own.sum()) * left // shards, method="marginals")
        return split(taken, left) + split(own - taken, shards - left)

    return split(np.array(quotas, dtype=np.int64), n_shards)


def mix(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_passes: int = 3,
        block_words: int = 256, seed: int = 17, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, pieces)``.

    ``row_col`` names a column of distinct numbers of the rows; without it they
    are numbered here.  ``rows`` has a row per document: ``row, id, size, source_size, target``.
    ``pieces`` has what the mix takes: ``row, id, size, shard, pass,
    first_word, n_words, order_key`` (words ``first_word .. first_word + n_words - 1`` of
    the document, in reading pass ``pass``); a shard's content is its pieces in
    ``order_key`` order.  Every source gives its rounded target exactly.  Null
    and blank texts have size 0 and give no piece; a null source is a source
    of its own; rows that repeat an id are documents of their own.  The result
    depends on ids, sizes and ``seed`` only.  An empty table gives empty
    results; other columns are not read.
    """
    spark = docs.sparkSession
    base = stored(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        n_words(text_col).alias("size"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("h"),
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row")), "mix-rows")
    targets = stored(source_targets(base.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), weights, max_passes), "mix-targets")

    # one row per source
    table = targets.orderBy("src").collect()
    goal = [min(round(t["target"]), max_passes * t["source_size"]) for t in table]
    block = max(block_words, -(-sum(goal) // MOST_BLOCKS))
    quota = [-(-g // block) for g in goal]
    cuts = np.cumsum([[0] * len(table), *splitting_tree(quota, n_shards, seed)], axis=0) if table else np.zeros((1, 0))
    plan = [{"src": i, "goal": g, "cuts": [min(g, int(c) * block) for c in cuts[:, i]]} for i, g in enumerate(goal)]
    quotas = spark.range(1).select(F.inline(F.from_json(
        F.lit(json.dumps(plan)), "array<struct<src: int, goal: bigint, cuts: array<bigint>>>")))

    # one row per source, counted above
    known = F.broadcast(targets.join(F.broadcast(quotas), "src"))
    rows = base.join(known, base["source"].eqNullSafe(known["source"])).select(
        "row", "id", "size", "h", "src", "source_size", "target", "goal", "cuts")

    # place in the permuted order: place in the bucket plus the words of earlier buckets
    buckets = max(64, sum(t["n_docs"] for t in table) // BUCKET_DOCS)
    placed = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    sums = placed.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    before = sums.select("src", "bucket", F.coalesce(F.sum("words").over(
        Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("earlier"))
    inside = F.sum("size").over(Window.partitionBy("src", "bucket").orderBy("h", "id", "size", "row")
                                .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    start = placed.withColumn("inside", inside).join(before, ["src", "bucket"]) \
        .withColumn("start", F.col("earlier") + F.col("inside"))

    again = start.filter("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1)))) \
        .withColumn("start", F.col("start") + F.col("pass") * F.col("source_size")).filter("start < goal")
    parts = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda k: F.struct(
        k.alias("shard"),
        F.greatest(F.col("start"), F.col("cuts")[k]).alias("a"),
        F.least(F.col("start") + F.col("size"), F.col("cuts")[k + 1]).alias("b")))
    pieces = again.withColumn("part", F.explode(F.filter(parts, lambda p: p["a"] < p["b"]))).select(
        "row", "id", "size", "part.shard", "pass", (F.col("part.a") - F.col("start")).alias("first_word"),
        (F.col("part.b") - F.col("part.a")).alias("n_words"),
        F.xxhash64(F.lit(seed), "part.shard", "id", "row", "pass").alias("order_key"))
    return rows.select("row", "id", "size", "source_size", "target"), pieces


def shuffled(pieces: DataFrame) -> DataFrame:
    """Pieces in the order in which shards are written: by shard, then locally shuffled."""
    return pieces.repartitionByRange("shard", "order_key").sortWithinPartitions("shard", "order_key")


def taken_words(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """``rows`` with ``taken``, the words that the mix takes of each document."""
    took = pieces.groupBy("row").agg(F.sum("n_words").alias("taken"))
    return rows.join(took, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    length_col: str | None = "n_chars", **options) -> DataFrame:
    """The mix as documents: a row for every piece, with the columns of ``docs``.

    A piece that is a whole document has its text; of others the text is the
    words taken, joined by single blanks, and ``length_col`` is its length.
    Rows are told apart by a number that is written with them, so rows that
    repeat an id, and those without one, give their own pieces only.
    """
    given = stored(docs.withColumn("place in table", F.monotonically_increasing_id()), "mix-documents")
    _, pieces = mix(given, id_col=id_col, text_col=text_col, source_col=source_col, row_col="place in table",
                    **options)
    wanted = stored(pieces.select(F.col("row").alias("of"), "first_word", F.col("n_words").alias("take"), "size"),
                    "mix-pieces")
    if wanted.count() <= BROADCAST_PIECES:
        wanted = F.broadcast(wanted)
    joined = given.join(wanted, given["place in table"] == wanted["of"])
    cut = wanted["take"] < wanted["size"]
    words = F.regexp_extract_all(given[text_col], F.lit(f"[^{BLANK}]+"), F.lit(0))
    part = F.array_join(F.slice(words, (wanted["first_word"] + 1).cast("int"), wanted["take"].cast("int")), " ")
    text = F.when(cut, part).otherwise(given[text_col])
    changed = {text_col: text}
    if length_col in docs.columns:
        changed[length_col] = F.when(cut, F.length(part).cast("long")).otherwise(given[length_col])
    return joined.select(*[changed.get(c, given[c]).alias(c) for c in docs.columns])
