"""Substring deduplication by level-wise doubling of repeated windows (operator 11).

Every word is removed that is covered by a window of ``length`` words whose
word sequence also starts in a document with a smaller id.

*Levels.*  A window can only repeat if every shorter window inside it does.
Each window of ``length`` words is therefore stood for by one window of every
smaller level: at the lowest level by the least hashed one inside it (its
anchor, about one start in 20 words), then by that one extended to twice the
length, to the right where it still lies inside, else to the left.  Level by
level the standing windows are counted by two aggregations (smallest and
largest id of a hash); only windows that two ids hold are extended, until the
length asked for is reached or no candidate survives.

*Last level.*  Windows that share an anchor and have survived together are a
run.  A run that a smaller id holds as a whole is decided by one row; the
windows of the other runs are compared one by one.

Equality is that of 64-bit hashes.  Rows are known by id and text hash, so that
rows of one id with different texts are different documents, and equal rows
have equal results.  The texts are read from the input by each level and are
never stored; what is known of a document is joined to it by broadcast when its
table is small (:data:`BROADCAST_BYTES`), else by a shuffle.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import discard, stored, stored_bytes, text_of

#: The lowest level has at most this many words.
LOWEST = 16
#: Window hashes that a task gathers before it passes them on.
FLUSH = 200_000
#: Bytes of a stored table of places up to which it is broadcast to the texts.
BROADCAST_BYTES = 24_000_000

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, at least n of each."""
    if base not in _tables or len(_tables[base][0]) < n:
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            factors = np.full(max(1 << 14, 1 << (n - 1).bit_length()), b, np.uint64)
            factors[0] = 1
            made.append(np.multiply.accumulate(factors))
        _tables[base] = (made[0], made[1])
    return _tables[base]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of value times power of the base, modulo 2**64."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values) + 1)[0][:len(values)], out=out[1:])
    return out


def word_sums(raw: bytes) -> np.ndarray:
    """Prefix sums over the hashes of the words of a text; one more than there are words."""
    chars = np.frombuffer(raw, np.uint8)
    edge = np.diff(np.concatenate([[True], _BLANK[chars], [True]]).view(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = _sums(chars.astype(np.uint64) + np.uint64(1), _BASES[0])
    return _sums(_mixed((sums[end] - sums[start]) * _powers(_BASES[0], len(raw) + 1)[1][start]
                        + (end - start).astype(np.uint64)), _BASES[1])


def windows_at(sums: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    """Hashes of the windows of ``size`` words that begin at ``start``."""
    return _mixed((sums[start + size] - sums[start]) * _powers(_BASES[1], len(sums))[1][start])


def levels(length: int) -> list[int]:
    """Window lengths from the lowest level to ``length``; each at most doubles the one before."""
    out = [length]
    while out[0] > LOWEST:
        out.insert(0, -(-out[0] // 2))
    return out


def standing(sums: np.ndarray, length: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``length`` words: its anchor, and the start of its window of ``level`` words."""
    sizes = levels(length)
    at = np.arange(len(sums) - sizes[0])
    grams = windows_at(sums, at, sizes[0])
    places, span, least = length - sizes[0] + 1, 1, at
    while span * 2 <= places:  # index of the least hash of 2 * span places, leftmost of equals
        left, right = least[:-span], least[span:]
        least = np.where(grams[right] < grams[left], right, left)
        span *= 2
    n = len(sums) - length
    left, right = least[:n], least[places - span:places - span + n]
    anchor = np.where(grams[right] < grams[left], right, left)
    own = np.arange(n)
    start, size = anchor, sizes[0]
    for wider in sizes[1:sizes.index(level) + 1]:
        start = own if wider == length else np.where(start + wider <= own + length, start, start + size - wider)
        size = wider
    return anchor, start


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("t"),
                       text.cast("binary").alias("raw"))


def _with_places(texts: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """``id, t, raw`` and the document's ``places`` (an array, by a join on id and text hash)."""
    listed = places.select(F.col("id").alias("of"), F.col("t").alias("of_t"), "places")
    if stored_bytes(places) <= BROADCAST_BYTES:
        listed = F.broadcast(listed)
    return texts.join(listed, texts["id"].eqNullSafe(listed["of"]) & (texts["t"] == listed["of_t"]), how) \
        .select("id", "t", "raw", "places")


def _each(rows: DataFrame, found, columns: list[str]) -> DataFrame:
    """``id, t`` and ``columns`` (long) of what ``found(raw, places)`` gives for every document.

    ``places`` is the document's Arrow array of numbers or structs, or None where the rows have none.
    """
    import pyarrow as pa

    names = ["id", "t", *columns]

    def run(batches):
        parts, held = [], 0

        def batch():
            docs, ts, ns, got = zip(*parts)
            which = np.repeat(np.arange(len(ns)), ns)
            return pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()).take(pa.array(which)), pa.array(np.repeat(np.array(ts, np.int64), ns)),
                 *(pa.array(np.concatenate(c).view(np.int64)) for c in zip(*got))], names)

        for b in batches:
            listed = b.column(3) if b.num_columns > 3 else None
            for i, (doc, t, raw) in enumerate(zip(*(b.column(k).to_pylist() for k in range(3)))):
                got = found(raw, listed[i].values if listed is not None else None)
                if got is not None and len(got[0]):
                    parts.append((doc, t, len(got[0]), got))
                    held += len(got[0])
                if held > FLUSH:
                    yield batch()
                    parts, held = [], 0
        if parts:
            yield batch()

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _holders(windows: DataFrame) -> DataFrame:
    """Per hash: smallest and largest id, and whether a row without an id holds it."""
    return windows.groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("high"),
                                    F.max(F.col("id").isNull()).alias("lone"))


#: Two ids hold the window; a null id stands after all others.
_REPEATED = "low < high or (lone and low is not null)"
#: A smaller id holds the window.
_EARLIER = "low < id or (id is null and low is not null)"


def _per_document(rows: DataFrame, place: str) -> DataFrame:
    return rows.groupBy("id", "t").agg(F.sort_array(F.collect_list(F.expr(place))).alias("places"))


def covered_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``id, t, places``: per document, sorted ``start, end`` of words that windows of a smaller id cover."""
    texts = _documents(docs, id_col, text_col)
    sizes = levels(length)
    alive, below = None, None
    for size in sizes[:-1]:
        def candidates(raw, places, size=size, below=below):
            sums = word_sums(raw)
            if len(sums) <= length:
                return None
            _, start = standing(sums, length, size)
            if places is not None:
                start = start[np.isin(standing(sums, length, below)[1], places.to_numpy())]
            start = np.unique(start)
            return windows_at(sums, start, size), start

        rows = texts if alive is None else _with_places(texts, alive, "inner")
        windows = stored(_each(rows, candidates, ["h", "start"]), "windows")
        repeated = stored(_holders(windows).filter(_REPEATED).select("h"), "windows-repeated")
        survivors = stored(_per_document(windows.join(repeated.hint("merge"), "h", "left_semi"), "start"),
                           "windows-alive")
        for used in (windows, repeated, *([alive] if alive is not None else [])):
            discard(used)
        alive, below = survivors, size
        if alive.isEmpty():
            break

    def runs(raw, places, below=below):
        """Runs of surviving windows: hash of all their words and places, first start, number."""
        sums = word_sums(raw)
        if len(sums) <= length:
            return None
        anchor, start = standing(sums, length, below if below is not None else length)
        own = np.arange(len(start))
        if places is not None:
            own = own[np.isin(start, places.to_numpy())]
        if not len(own):
            return None
        breaks = np.flatnonzero((np.diff(own) > 1) | (np.diff(anchor[own]) != 0)) + 1
        first = own[np.concatenate([[0], breaks])]
        n = np.diff(np.concatenate([[0], breaks, [len(own)]]))
        at = ((anchor[first] - first) * length + n).astype(np.uint64)
        return _mixed(windows_at(sums, first, n - 1 + length) + at * np.uint64(_BASES[0])), first, n

    rows = texts if alive is None else _with_places(texts, alive, "inner")
    found = stored(_each(rows, runs, ["h", "start", "n"]), "window-runs")
    holders = stored(_holders(found), "window-run-holders")
    judged = stored(found.join(holders.hint("merge"), "h").select(
        "id", "t", "start", "n", F.coalesce(F.expr(_EARLIER), F.lit(False)).alias("whole")), "window-runs-judged")
    single = stored(_per_document(judged.filter("not whole"), "struct(start, n)"), "window-runs-single")

    def each_window(raw, places):
        sums = word_sums(raw)
        first, n = (places.field(k).to_numpy(zero_copy_only=False) for k in range(2))
        start = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return windows_at(sums, start, length), start

    windows = stored(_each(_with_places(texts, single, "inner"), each_window, ["h", "start"]), "windows")
    holders2 = stored(_holders(windows).filter(_REPEATED), "windows-repeated")
    late = windows.join(holders2.hint("merge"), "h").filter(_EARLIER)
    spans = judged.filter("whole").select("id", "t", "start", (F.col("start") + F.col("n") - 1 + length).alias("end")) \
        .union(late.select("id", "t", "start", (F.col("start") + length).alias("end")))
    out = stored(_per_document(spans, "struct(start, end)"), "window-spans")
    for used in (found, holders, judged, single, windows, holders2, *([alive] if alive is not None else [])):
        discard(used)
    return out


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """One row per input row: ``id_col, n_words, n_removed, n_spans, kept``.

    Words are runs without ASCII white space, unchanged.  ``kept`` is the text
    of the words that stay, joined by one space; ``n_spans`` counts the maximal
    runs of removed words.  A word goes if a window of ``length`` words that
    covers it also starts in a row with a smaller id; windows are judged on the
    input, and never cross rows.  A repeated window in one row only, or in
    rows of one id only, removes nothing.  A null id counts as larger than all
    others (and not as smaller than another null id).  Null and empty texts and
    texts of fewer than ``length`` words keep all their words; a text may be as
    long as a row can be.  Repeated rows have equal results.  An empty table
    gives an empty result; other columns are not read.
    """
    import pyarrow as pa

    spans = covered_spans(docs, id_col, text_col, length)
    kind = dict(docs.dtypes)[id_col]

    def cut(batches):
        for b in batches:
            out = []
            for raw, listed in zip(b.column(2).to_pylist(), b.column(3)):
                words = raw.split()
                if not listed.is_valid:
                    out.append((len(words), 0, 0, b" ".join(words)))
                    continue
                start, end = (listed.values.field(k).to_numpy() for k in range(2))
                steps = np.zeros(len(words) + 1, np.int64)
                np.add.at(steps, start, 1)
                np.add.at(steps, end, -1)
                stays = np.cumsum(steps[:-1]) == 0
                opens = int((np.diff(np.concatenate([[True], stays]).astype(np.int8)) == -1).sum())
                out.append((len(words), int((~stays).sum()), opens, b" ".join(compress(words, stays))))
            n_words, n_removed, n_spans, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["id", "n_words", "n_removed", "n_spans", "kept"])

    return _with_places(_documents(docs, id_col, text_col), spans, "left") \
        .mapInArrow(cut, "id long, n_words long, n_removed long, n_spans long, kept string") \
        .select(F.col("id").cast(kind).alias(id_col), "n_words", "n_removed", "n_spans", "kept")
