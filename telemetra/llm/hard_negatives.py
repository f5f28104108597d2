"""Hard-negative mining by a residue-number-system matrix product (operator 12).

Vectors become integers; the score of two rows is their exact integer inner
product.  Rows and anchors are packed into blocks, every block of anchors meets
every block of rows once (blocks of rows are dealt over salts and the anchors
copied to each, so that a meeting is an ordinary equi-join and its tasks stay
small; the copies are shuffled, never broadcast), and a task multiplies the two
matrices modulo several primes below 256 in float32: residues are at most 125
in size, so sums over ``DEPTH`` components stay below 2**24 and are exact.
Centred mixed-radix digits (Chinese remaindering) give the signed score back;
there are as many primes as the largest squared norm asks for.

A first pass keeps every anchor's best rows of its own label, the second one,
which knows their scores, the best rows of other labels in each positive's
window of scores.  Each block keeps as many as the result needs, and a window
over the anchor selects among the blocks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.common import stored

#: Rows and anchors of a block.
ROWS, ANCHORS = 4096, 512
#: Blocks of rows are dealt over so many salts, and over more where a salt would hold over ``SALT_BLOCKS``.
SALTS, SALT_BLOCKS = 64, 8
#: Components whose products are summed in float32 before they are reduced.
DEPTH = 1024
#: Scores must stay below this, so that 100 times a score fits in a long.
LARGEST = 1 << 55

_NONE = np.iinfo(np.int64).min


def moduli(bound: int) -> list[int]:
    """Primes below 256, largest first, whose product exceeds twice ``bound``."""
    out, product = [], 1
    for p in range(255, 2, -2):
        if product > 2 * bound + 1:
            break
        if all(p % d for d in range(3, 16, 2)):
            out.append(p)
            product *= p
    return out


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    return (x + p // 2) % p - p // 2


def rns_product(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """``a @ b.T`` of integer matrices, exact while twice its size is below the product of the primes.

    The narrower matrix counts as padded with zeros.
    """
    width = min(a.shape[1], b.shape[1])
    digits: list[np.ndarray] = []
    for p in primes:
        left, right = (_centred(x[:, :width], p).astype(np.float32) for x in (a, b))
        residue = np.zeros((len(a), len(b)), np.int32)
        for k in range(0, width, DEPTH):
            residue += _centred((left[:, k:k + DEPTH] @ right[:, k:k + DEPTH].T).astype(np.int32), p)
        weight = 1
        for digit, q in zip(digits, primes):  # take away what the earlier digits stand for
            residue = _centred(residue - digit * (weight % p), p)
            weight *= q
        digits.append(_centred(residue * pow(weight, -1, p), p))
    out = np.zeros((len(a), len(b)), np.int64)
    for digit, p in zip(reversed(digits), reversed(primes)):
        out *= p
        out += digit
    return out


def _best(scores: np.ndarray, wanted: np.ndarray, k: int):
    """Places of the k best wanted scores of each row, leftmost of equals first."""
    left = np.where(wanted, scores, _NONE)
    every = np.arange(len(left))
    for _ in range(min(k, left.shape[1])):
        at = left.argmax(axis=1)
        has = left[every, at] != _NONE
        if not has.any():
            return
        yield every[has], at[has]
        left[every, at] = _NONE


def vectors_of(df: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column, scale: int) -> DataFrame:
    """``row, id, label, anchor, q``: rows that take part, with integer components."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    return df.filter(x.isNotNull() & finite & label.isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long")).alias("q"))


def _packed(rows: DataFrame, size: int, kind: str, extra: str | None = None) -> DataFrame:
    """Blocks of ``size`` rows, ordered by id (null last): ``block, row, id, label, width, q`` and ``extra``.

    ``q`` holds the components as numbers of type ``kind``, short rows padded with zeros.
    """
    import pyarrow as pa

    def pack(batches):
        held, n = [], 0

        def block():
            t = pa.Table.from_batches(held).sort_by([("known", "descending"), ("id", "ascending"), ("row", "ascending")])
            q = t.column("q").combine_chunks()
            widths = q.value_lengths().to_numpy()
            width = int(widths.max())
            dense = np.zeros((len(widths), width), kind)
            dense[np.arange(width) < widths[:, None]] = q.flatten().to_numpy()
            first = min(t.column("row").to_pylist())
            cells = [pa.array([first]), *(pa.array([t.column(c).to_pylist()]) for c in ("row", "id", "label")),
                     pa.array([width]), pa.array([dense.tobytes()], pa.binary())]
            if extra:
                cells.append(pa.array([t.column(extra).to_pylist()], pa.list_(pa.list_(pa.int64()))))
            cells[2] = cells[2].cast(pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(cells, names)

        for b in batches:
            while b.num_rows:
                part = b.slice(0, size - n)
                b = b.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == size:
                    yield block()
                    held, n = [], 0
        if n:
            yield block()

    names = ["block", "row", "id", "label", "width", "q", *([extra] if extra else [])]
    columns = "block long, row array<long>, id array<long>, label array<long>, width long, q binary" \
        + (f", {extra} array<array<long>>" if extra else "")
    return rows.select("row", "id", "label", "q", F.col("id").isNotNull().alias("known"), *([extra] if extra else [])) \
        .mapInArrow(pack, columns)


def _met(anchors: DataFrame, blocks: DataFrame, n_blocks: int, kind: str, primes: list[int], pick, columns: str) -> DataFrame:
    """``pick(scores, anchors, rows)`` of every block of anchors with every block of rows."""
    import pyarrow as pa

    salts = max(min(n_blocks, SALTS), -(-n_blocks // SALT_BLOCKS), 1)
    left = anchors.select(F.struct(*anchors.columns).alias("a"),
                          F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    right = blocks.select(F.struct(*blocks.columns).alias("b"),
                          F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"))

    def side(cell):
        return {name: cell[name].values.to_numpy(zero_copy_only=False) for name in ("row", "label")} | {
            "id": cell["id"].values, "positives": cell["positives"].as_py() if "positives" in cell else None,
            "q": np.frombuffer(cell["q"].as_buffer(), kind).reshape(len(cell["row"]), cell["width"].as_py())
            .astype(np.int64)}

    def meet(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = side(batch.column(0)[i]), side(batch.column(1)[i])
                for out in pick(rns_product(a["q"], b["q"], primes), a, b):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in out],
                                                     [c.split()[0] for c in columns.split(", ")])

    # a broadcast would collect the anchors' copies of all salts on the driver: the stored size does not count them
    return left.join(right.hint("merge"), "salt").select("a", "b").mapInArrow(meet, columns)


def hard_negatives(df: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column,
                   n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A component x counts as floor(scale * x), a score is the integer inner
    product with the anchor.  An anchor's positives are its ``n_positives``
    best other rows of its label; for each, the ``n_negatives`` best rows of
    other labels whose score is ``low`` to ``high`` percent of the positive's
    are returned, ranked from 1.  Ties go to the smaller id, null ids last.

    Rows with a null label, a null vector, or a null or non-finite component
    take no part.  Rows are told apart by place: a repeated row is another row
    and can be a positive of its copy, and an anchor repeated k times gives its
    rows k times.  Vectors of other lengths count as padded with zeros (an
    empty one scores 0).  An anchor without positives, and a positive without
    negatives, has no rows.  An empty table gives an empty result, other
    columns are not read.  Scores of 2**55 and more raise ValueError.
    """
    rows = stored(vectors_of(df, id_col, vector_col, label, anchor, scale), "vectors")
    size = rows.agg(F.max(F.aggregate("q", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))).alias("norm"),
                    F.max(F.greatest(F.array_max("q"), -F.array_min("q"))).alias("most")).first()
    bound = int((size["norm"] or 0) * 1.0001) + 1
    if bound >= LARGEST:
        raise ValueError(f"scores up to {bound} do not fit: scale the vectors down")
    primes = moduli(bound)
    kind = next(k for k in ("int16", "int32", "int64") if (size["most"] or 0) < np.iinfo(k).max)
    blocks = stored(_packed(rows.select("row", "id", "label", "q"), ROWS, kind), "vector-blocks")
    n_blocks = blocks.count()

    def positives(scores, a, b):
        same = (a["label"][:, None] == b["label"]) & (a["row"][:, None] != b["row"])
        for of, at in _best(scores, same, n_positives):
            yield a["row"][of], b["row"][at], b["id"].take(at), scores[of, at]

    anchors = rows.filter("anchor").select("row", "id", "label", "q")
    found = _met(stored(_packed(anchors, ANCHORS, kind), "anchor-blocks"), blocks, n_blocks, kind, primes, positives,
                 "anchor_row long, row long, id long, score long")
    order = (F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row"))
    first = stored(found.withColumn("place", F.row_number().over(Window.partitionBy("anchor_row").orderBy(*order)))
                   .filter(F.col("place") <= n_positives), "positives")

    asked = first.groupBy("anchor_row").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("place", "score"))), lambda p: p["score"]).alias("positives"))
    asking = rows.filter("anchor").join(asked.withColumnRenamed("anchor_row", "row"), "row") \
        .select("row", "id", "label", "q", "positives")

    def negatives(scores, a, b):
        other = a["label"][:, None] != b["label"]
        for k in range(n_positives):
            of = np.array([i for i, p in enumerate(a["positives"]) if len(p) > k], np.int64)
            if not len(of):
                return
            theirs = np.array([a["positives"][i][k] for i in of.tolist()], np.int64)[:, None]
            inside = other[of] & (100 * scores[of] >= low * theirs) & (100 * scores[of] <= high * theirs)
            for which, at in _best(scores[of], inside, n_negatives):
                yield (a["row"][of[which]], np.full(len(at), k + 1, np.int32), b["row"][at], b["id"].take(at),
                       scores[of[which], at])

    found = _met(stored(_packed(asking, ANCHORS, kind, "positives"), "anchor-blocks"), blocks, n_blocks, kind, primes,
                 negatives, "anchor_row long, place int, row long, id long, score long")
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_row", "place").orderBy(*order))) \
        .filter(F.col("rank") <= n_negatives) \
        .select("anchor_row", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return first.select("anchor_row", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")) \
        .join(best, ["anchor_row", "place"]) \
        .join(rows.filter("anchor").select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id")), "anchor_row") \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
