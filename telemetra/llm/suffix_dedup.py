"""Suffix-array deduplication by a logarithmic index family (operator 1).

Every byte is removed that is covered by a string of ``length`` bytes which
also starts anywhere else in the corpus.

*Suffix arrays.*  Of every window of ``length`` bytes, the suffix that starts
at its least hashed ``GRAM``-gram is indexed (its anchor), about one suffix in
85 bytes; equal windows have equal anchors at equal places.  An entry is the
anchor's run of windows: ``key`` identifies the first ``GRAM`` bytes of the
suffix, ``ctx`` all bytes of the run's windows.  A batch's array is its entries
sorted by key, dealt over partitions by key.

*Levels.*  A new batch is merged with the levels of its size and smaller ones
that the merge makes equal (a binary counter), in one exchange; while the
sorted entries pass, neighbours with equal keys are counted, which is the scan
for long matches between the batch and those levels.  Levels that stay are
scanned by a join on the keys.  So a byte is moved a logarithmic number of
times.

*Matches.*  Runs whose ``ctx`` occurs again are duplicates as a whole.  Runs
that share a key only are compared window by window, one representative per
``ctx``.  Equality is that of 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.common import discard, stored

GRAM = 32
#: Window starts handled at once; places within fit in 24 bits.
CHUNK = 1 << 19
#: Window hashes that a task gathers before it passes them on.
FLUSH = 200_000
#: Rows up to which per-document places are broadcast to the text (some 30 bytes each).
BROADCAST_ROWS = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    size = max(1 << 12, 1 << (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for base in (_BASE, inverse):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            with np.errstate(over="ignore"):
                tables.append(np.multiply.accumulate(factors))
        _powers[size] = (tables[0], tables[1])
    return next(iter(_powers.values()))


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sums(raw: np.ndarray) -> np.ndarray:
    """Prefix sums of byte times power of the base; bytes count from 1."""
    up, _ = _power_tables(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all strings of ``width`` bytes, by start."""
    n = len(sums) - width
    _, down = _power_tables(len(sums))
    with np.errstate(over="ignore"):
        return _mix((sums[width:] - sums[:n]) * down[:n])


def entries(raw: bytes, length: int) -> tuple[np.ndarray, ...]:
    """``key, ctx, at, left, run`` of a document's anchors.

    The run's windows start at ``at - left .. at - left + run``.
    """
    out: list[tuple[np.ndarray, ...]] = []
    places = length - GRAM + 1
    for begin in range(0, len(raw) - length + 1, CHUNK):
        part = raw[begin:begin + CHUNK + length - 1]
        grams = _hashes(_sums(np.frombuffer(part, np.uint8)), GRAM)
        least = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while span * 2 <= places:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        n = len(part) - length + 1
        least = np.minimum(least[:n], least[places - span:places - span + n])
        anchor = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        last = np.concatenate([first[1:], [n]]) - 1
        at = anchor[first]
        ctx = np.fromiter((xxhash.xxh3_64_intdigest(part[a:b + length], c - a) for a, b, c in
                           zip(first.tolist(), last.tolist(), at.tolist())), np.uint64, len(at))
        out.append((grams[at].view(np.int64), ctx.view(np.int64), at + begin, at - first, last - first))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc`` (a hash of id and text, which tells rows apart unless they are equal) and ``raw`` (UTF-8 bytes)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(F.col(id_col), text).alias("doc"),
                       F.col(id_col).alias("id"), text.cast("binary").alias("raw"))


class SuffixIndex:
    """Levels of sorted suffix entries; ``add`` takes batches of documents."""

    def __init__(self, length: int = 200):
        self.length = length
        self.levels: list[tuple[int, DataFrame]] = []  # (batches merged, entries), large to small

    def _array(self, batch: DataFrame) -> DataFrame:
        import pyarrow as pa

        length = self.length

        def run(batches):
            for b in batches:
                got = [(doc, entries(raw, length)) for doc, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                       if len(raw) >= length]
                if got:
                    columns = [np.concatenate(x) for x in zip(*(e for _, e in got))]
                    doc = np.repeat(np.array([d for d, _ in got], np.int64), [len(e[0]) for _, e in got])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0]), pa.array(columns[1]), pa.array(doc), pa.array(columns[2]),
                         pa.array(columns[3].astype(np.int16)), pa.array(columns[4].astype(np.int16))],
                        ["key", "ctx", "doc", "at", "left", "run"])

        return batch.select("doc", "raw").mapInArrow(
            run, "key long, ctx long, doc long, at long, left short, run short")

    def add(self, batch: DataFrame) -> list[DataFrame]:
        """Index ``batch`` (``doc, raw``); the matches with each level that was scanned.

        The new level's entries carry ``same_key`` and ``same_ctx``, the
        numbers of its entries with that key and context; matches with the
        levels that stay are given as keys.
        """
        size, parts, used = 1, [self._array(batch)], []
        while self.levels and self.levels[-1][0] <= size:
            n, level = self.levels.pop()
            used.append(level)
            parts.append(level.select("key", "ctx", "doc", "at", "left", "run"))
            size += n
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.union(part)
        by_key = Window.partitionBy("key")
        by_ctx = Window.partitionBy("key", "ctx")
        counted = merged.withColumn("same_ctx", F.count(F.lit(1)).over(by_ctx)) \
            .withColumn("first", F.row_number().over(by_ctx.orderBy("doc", "at")) == 1) \
            .withColumn("same_key", F.count(F.lit(1)).over(by_key))
        fresh = stored(counted, "suffix-level")
        for level in used:
            discard(level)
        scans = [fresh.select("key").join(level.select("key").distinct(), "key", "left_semi").distinct()
                 for _, level in self.levels]
        self.levels.append((size, fresh))
        return scans

    def merged(self) -> DataFrame:
        """All entries as one level (the last merge of a batch job)."""
        if len(self.levels) > 1:
            parts = [level for _, level in self.levels]
            size = sum(n for n, _ in self.levels)
            all_of = parts[0]
            for part in parts[1:]:
                all_of = all_of.union(part)
            by_ctx = Window.partitionBy("key", "ctx")
            self.levels = [(size, stored(
                all_of.select("key", "ctx", "doc", "at", "left", "run")
                .withColumn("same_ctx", F.count(F.lit(1)).over(by_ctx))
                .withColumn("first", F.row_number().over(by_ctx.orderBy("doc", "at")) == 1)
                .withColumn("same_key", F.count(F.lit(1)).over(Window.partitionBy("key"))), "suffix-level"))]
            for part in parts:
                discard(part)
        return self.levels[0][1]


def _beside(texts: DataFrame, places: DataFrame, n_places: int, how: str) -> DataFrame:
    """Join per-document places to the texts; broadcast when they are few."""
    return texts.join(F.broadcast(places) if n_places <= BROADCAST_ROWS else places, "doc", how)


def _equal_windows(texts: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """``doc, start``: windows of unique runs that also occur in another run of their key."""
    import pyarrow as pa

    runs = stored(runs, "suffix-runs")
    per_doc = runs.groupBy("doc").agg(F.collect_list(F.struct(
        (F.col("at") - F.col("left")).alias("start"), "run", (F.col("same_ctx") == 1).alias("ask"))).alias("runs"))

    names = ["window", "doc", "start", "ask"]

    def windows(batches):
        for b in batches:
            listed = b.column(2)
            ends, of = listed.offsets.to_numpy(), listed.values
            begins, lasts, asks = (of.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            parts, held = [], 0
            for i, doc in enumerate(b.column(0).to_pylist()):
                raw = np.frombuffer(b.column(1)[i].as_buffer(), np.uint8)
                for begin, last, ask in zip(begins[ends[i]:ends[i + 1]].tolist(), lasts[ends[i]:ends[i + 1]].tolist(),
                                            asks[ends[i]:ends[i + 1]].tolist()):
                    n = last + 1
                    if begin + last + length > len(raw):
                        continue  # a run of another text of this id
                    hashes = _hashes(_sums(raw[begin:begin + last + length]), length).view(np.int64)
                    parts.append((hashes, np.full(n, doc, np.int64), np.arange(begin, begin + n), np.full(n, ask)))
                    held += n
                if held > FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names)
                    parts, held = [], 0
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names)

    rows = _beside(texts.select("doc", "raw"), per_doc, runs.count(), "inner").select("doc", "raw", "runs") \
        .mapInArrow(windows, "window long, doc long, start long, ask boolean")
    return rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("window"))) \
        .filter("n > 1 and ask").select("doc", "start")


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                    batches: int = 4) -> DataFrame:
    """``doc, start, end``: the maximal runs of bytes to remove (see :func:`remove_duplicates`)."""
    texts = _keyed(docs, id_col, text_col)
    index = SuffixIndex(length)
    for k in range(batches):
        index.add(texts.filter(F.pmod(F.xxhash64("doc"), F.lit(batches)) == k))
    level = index.merged().filter("same_key > 1")
    begin = F.col("at") - F.col("left")
    whole = level.filter("same_ctx > 1").select("doc", begin.alias("start"),
                                                (begin + F.col("run") + length).alias("end"))
    single = _equal_windows(texts, level.filter("same_key > same_ctx and first"), length) \
        .select("doc", "start", (F.col("start") + length).alias("end"))
    in_doc = Window.partitionBy("doc").orderBy("start", "end")
    reach = F.max("end").over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    marked = whole.union(single).withColumn("opens", F.when(F.col("start") <= reach, 0).otherwise(1)) \
        .withColumn("island", F.sum("opens").over(in_doc.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("doc", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")) \
        .select("doc", "start", "end")


def remove_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                      batches: int = 4) -> DataFrame:
    """One row per input row: ``id_col, n_bytes, n_removed, n_spans, kept``.

    ``kept`` (binary) is the UTF-8 text without every byte that lies in a
    string of ``length`` bytes which also starts elsewhere, in the same or
    another row; strings are judged on the input, and never cross rows.  Null
    and empty texts and texts shorter than ``length`` keep all bytes.  Repeated
    rows are occurrences like any other.  Rows that repeat an id with
    different texts are different documents.  An empty table gives an empty result; other
    columns are not read.
    """
    import pyarrow as pa

    spans = stored(duplicate_spans(docs, id_col, text_col, length, batches), "suffix-spans")
    n_spans = spans.count()
    per_doc = spans.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    kind = dict(docs.dtypes)[id_col]

    def cut(batches_):
        for b in batches_:
            kept, removed, n_runs, n_bytes = [], [], [], []
            for raw, listed in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                at, pieces, runs = 0, [], 0
                for s in listed or ():
                    if s["start"] < len(raw):
                        pieces.append(raw[at:s["start"]])
                        at = min(s["end"], len(raw))
                        runs += 1
                rest = b"".join(pieces) + raw[at:]
                kept.append(rest)
                removed.append(len(raw) - len(rest))
                n_runs.append(runs)
                n_bytes.append(len(raw))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(n_runs, pa.int64()), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return _beside(_keyed(docs, id_col, text_col), per_doc, n_spans, "left").select("id", "raw", "spans") \
        .mapInArrow(cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary") \
        .withColumnRenamed("id", id_col)
