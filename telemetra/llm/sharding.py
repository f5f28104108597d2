"""Sharding by histogram sort (operator 6).

Rows are ordered by a 63-bit key (checksum of the text, then a hash of the
id), so equal texts stand together and the order is otherwise random.  Key
boundaries of near-equal byte shares are found without sorting: candidate
boundaries (probes) are laid into the key interval of each boundary that is
still open, every partition counts the exact bytes and rows between probes,
the counts are added up, and each interval shrinks to the two probes around
its target.  When all boundaries meet their tolerance, rows are exchanged
once, into cells that subdivide the shards, and numbered there.

Only histograms (at most ``MAX_PROBES`` + 1 rows or the number of cells,
whichever is more) reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.common import stored, text_of

MAX_PROBES = 4096
KEY_END = 1 << 63
LOW_BITS = 31


def _histogram(rows: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows with key below each probe (exact, one pass)."""
    edges = probes.astype(np.uint64)

    def count(batches):
        import pandas as pd

        n_bytes = np.zeros(len(edges) + 1, np.int64)
        n_rows = np.zeros(len(edges) + 1, np.int64)
        for pdf in batches:
            cell = np.searchsorted(edges, pdf["key"].to_numpy().astype(np.uint64), "right")
            np.add.at(n_bytes, cell, pdf["size"].to_numpy())
            n_rows += np.bincount(cell, minlength=len(edges) + 1)
        full = np.nonzero(n_rows)[0]
        yield pd.DataFrame({"cell": full, "n_bytes": n_bytes[full], "n_rows": n_rows[full]})

    got = rows.select("key", "size").mapInPandas(count, "cell long, n_bytes long, n_rows long") \
        .groupBy("cell").agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_rows").alias("n_rows")).collect()
    cells = np.zeros((2, len(edges) + 1), np.int64)
    for r in got:
        cells[:, r["cell"]] = r["n_bytes"], r["n_rows"]
    below = np.cumsum(cells, axis=1)[:, :-1]
    return below[0], below[1]


def _refine(rows: DataFrame, targets: list[tuple[float, float, float, float]], total: tuple[int, int]
            ) -> list[int]:
    """Splitter keys; a target is (weight of a byte, weight of a row, share below, tolerance)."""
    low = [0] * len(targets)
    high = [KEY_END] * len(targets)
    at_low = [0.0] * len(targets)
    at_high = [a * total[0] + b * total[1] for a, b, _, _ in targets]

    def settled(i):
        _, _, aim, slack = targets[i]
        return min(aim - at_low[i], at_high[i] - aim) <= slack or high[i] - low[i] <= 1

    while open_ := [i for i in range(len(targets)) if not settled(i)]:
        per = max(3, MAX_PROBES // len(open_))
        probes = set()
        for span in {(low[i], high[i]) for i in open_}:
            sharing = sum((low[i], high[i]) == span for i in open_)
            n = min(per * sharing, span[1] - span[0] - 1)
            probes.update(span[0] + (span[1] - span[0]) * k // (n + 1) for k in range(1, n + 1))
        keys = sorted(probes - {0})
        n_bytes, n_rows = _histogram(rows, np.array(keys, dtype=np.uint64))
        for i in open_:
            a, b, aim, _ = targets[i]
            mass = a * n_bytes + b * n_rows
            k = int(np.searchsorted(mass, aim, "left"))
            if k < len(keys) and keys[k] < high[i]:
                high[i], at_high[i] = keys[k], float(mass[k])
            if k > 0 and keys[k - 1] > low[i]:
                low[i], at_low[i] = keys[k - 1], float(mass[k - 1])
    return [low[i] if targets[i][2] - at_low[i] <= at_high[i] - targets[i][2] else high[i]
            for i in range(len(targets))]


def shard_by_bytes(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                   tolerance: float = 0.002, group_tolerance: float = 0.01,
                   cells_per_shard: int | None = None) -> DataFrame:
    """Near-equal byte shards: ``id_col, size, text_crc32, shard, slot``.

    ``size`` is the UTF-8 length of the text (null: 0) plus 1.  A shard ends
    within ``tolerance`` of the ideal shard size, or at the nearest row where
    rows are larger than that; it moves to the edge of a group of equal texts
    when the edge is within ``group_tolerance``, so such groups are cut only
    where balance needs it.  ``slot`` numbers a shard's rows from 0 in key
    order.  Rows without an id are told
    apart by their place in the table, so that they can be cut like others.
    Rows that repeat one id and text share one key and stay in one shard.  An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    crc = F.crc32(text_of(text_col).cast("binary"))
    own = F.when(F.col(id_col).isNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.xxhash64(id_col))
    low = own.bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    rows = stored(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text_of(text_col)) + 1).cast("long").alias("size"),
        crc.alias("crc"), F.shiftleft(crc, LOW_BITS).bitwiseOR(low).alias("key")), "shard-rows")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    n_bytes, n_rows = int(total[0]), int(total[1])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per = cells_per_shard or max(1, -(-parts // n_shards))
    splitters: list[int] = []
    inner: list[int] = []
    if n_rows:
        ideal = n_bytes / n_shards
        splitters = _refine(rows, [(1.0, 0.0, ideal * j, ideal * tolerance) for j in range(1, n_shards)],
                            (n_bytes, n_rows))
        # the edges of the group of equal texts that a boundary cuts
        edges = sorted({e for s in splitters for e in ((s >> LOW_BITS) << LOW_BITS,
                                                       min(((s >> LOW_BITS) + 1) << LOW_BITS, KEY_END - 1))})
        below, _ = _histogram(rows, np.array(edges, dtype=np.uint64))
        for j, s in enumerate(splitters, 1):
            near = [(abs(float(below[edges.index(e)]) - ideal * j), e)
                    for e in edges if abs(e - s) <= 1 << LOW_BITS]
            off, edge = min(near)
            if off <= group_tolerance * ideal:
                splitters[j - 1] = edge
        splitters.sort()
        # cells of near-equal work inside the shards; they bound what one task numbers
        cells = n_shards * per
        inner = _refine(rows, [(1.0 / n_bytes, 1.0 / n_rows, 2.0 * c / cells, 0.5 / cells)
                               for c in range(1, cells)], (n_bytes, n_rows))
    bounds = sorted(set(splitters) | set(inner))
    edges = np.array(bounds, dtype=np.uint64)
    shard_ends = np.array(splitters, dtype=np.uint64)

    _, rows_below = _histogram(rows, edges) if bounds else (None, np.zeros(0, np.int64))
    starts = np.concatenate([[0], rows_below]).astype(np.int64)
    keys = np.concatenate([np.zeros(1, np.uint64), edges])  # all of one type: floats would lose the low bits
    shard_of = np.searchsorted(shard_ends, keys, "right")
    first = {s: int(starts[shard_of == s][0]) for s in set(shard_of.tolist())}
    offsets = spark.createDataFrame(
        [(i, int(shard_of[i]), int(starts[i]) - first[int(shard_of[i])]) for i in range(len(keys))],
        "cell int, shard int, before long")

    @F.pandas_udf("int")
    def cell_of(key):
        import pandas as pd

        return pd.Series(np.searchsorted(edges, key.to_numpy().astype(np.uint64), "right").astype("int32"))

    local = Window.partitionBy("cell").orderBy("key", "id")
    numbered = rows.withColumn("cell", cell_of("key")).withColumn("rn", F.row_number().over(local))
    # one row per cell: as many as the shuffle has partitions
    return numbered.join(F.broadcast(offsets), "cell").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("before") + F.col("rn") - 1).cast("long").alias("slot"))
