"""Stupid-backoff language-model scores (operator 7).

A document's score is the sum over its words of log10 S, S being the first of

* (c(g) - c_d(g)) / c(context of g) for the k-gram g that ends with the word,
  k from the order of the model down to 2, where g occurs in another document,
  that is where its count exceeds the document's own count c_d,
* c(w) / N for the word itself,

times 0.4 for every step down.  A document begins with ``order - 1`` marks.

Texts are packed into blocks of some ``BLOCK_WORDS`` words (``blocks``), and an
n-gram is sent to its counting task once for every block that has it, not for
every document.  For each order, blocks send their distinct n-grams with their
counts, in arrays, one for each range of hashes (``sent``); the rows of a range
are grouped and every block gets back, in the same order, how often its n-grams
occur in other blocks (``counted``).  Those of orders 1 and 2 are sent at once.
Of higher orders only n-grams are sent whose last and first words but one occur
in another document, as the others occur in no other document themselves.  The
context of an n-gram occurs in the same text, so its count is known there too;
blocks and counts are joined and the words scored (``scored``).

A document is in one block, but for those of a repeated id with more words than
a block: each of their blocks also sends its n-grams mixed with the id, and so
gets the document's own counts.

No key is frequent: an n-gram occurs once in a block's arrays.  Logarithms are
held in millionths, so sums do not depend on the order of addition.  Words are
known by 62-bit hashes, n-grams by 64-bit hashes of these.

``ngrams`` and ``count_tables`` give the model itself as tables.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import BROADCAST_IDS, Remembered, discard, forget_others, forgetting, stored

BACKOFF = 0.4
#: N-grams of a broadcast table at most (24 bytes each).
HOT = 100_000
#: Rows of an Arrow batch that a task passes on, about.
BATCH_ROWS = 50_000
#: Words of a block of texts, about; a longer text is a block of its own.
BLOCK_WORDS = 500_000
#: Words whose n-grams one counting task takes, about, on large inputs; on smaller ones there are ``LEAST_PARTS``.
PART_WORDS = 3_000_000
LEAST_PARTS = 128
#: Mark before the first word; hashes of words are larger.
BEGIN = 1

_word_hash = Remembered(lambda word: (xxhash.xxh3_64_intdigest(word) >> 2) | 2, room=60_000)


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _distinct(words: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A document's distinct n-grams: their words, the last first, and its counts of orders 2 to ``order``."""
    padded = np.concatenate([np.full(order - 1, BEGIN, np.uint64), words])
    back = [padded[order - 1 - k:len(padded) - k] for k in range(order)]
    gram, counts = back[0], []
    for k in range(1, order):
        gram = _mix(_mix(gram) ^ back[k])
        _, first, place, times = np.unique(gram, return_index=True, return_inverse=True, return_counts=True)
        counts.append(times[place])
    return [b[first] for b in back], [c[first] for c in counts]


def words_of(order: int) -> list[str]:
    """Columns of an n-gram's words, the last word first."""
    return [f"w{k}" for k in range(order)]


def gram(order: int, skip: int = 0) -> Column:
    """Key of the ``order``-gram that ends ``skip`` words before the end of a row."""
    words = [F.col(w) for w in words_of(order + skip)[skip:]]
    return words[0] if order == 1 else F.xxhash64(*words)


def ngrams(texts: DataFrame, order: int) -> DataFrame:
    """``doc, w0 .., own2 ..`` of every row of ``texts`` (``doc, text``): its distinct n-grams.

    ``own2 ..`` are the row's counts of the bigram .. the n-gram that end there.
    """
    import pyarrow as pa

    columns = ["doc", *words_of(order), *[f"own{k}" for k in range(2, order + 1)]]

    def explode(batches):
        forget_others(_word_hash)
        held: list[list[np.ndarray]] = [[] for _ in columns]
        rows = 0
        for batch in batches:
            _word_hash.trim()
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()
                if not words:
                    continue
                grams, counts = _distinct(
                    np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words)), order)
                rows += len(grams[0])
                for column, values in zip(held, [np.full(len(grams[0]), doc, np.int64),
                                                 *[g.view(np.int64) for g in grams], *counts]):
                    column.append(values.astype(np.int64, copy=False))
                if rows >= BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in held], columns)
                    held, rows = [[] for _ in columns], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in held], columns)

    return texts.mapInArrow(explode, ", ".join(f"{c} long" for c in columns))


def _with_counts(rows: DataFrame, key: Column, table: DataFrame, n_words: int) -> DataFrame:
    """``rows`` with the columns of ``table`` (``g, c, ..``) at ``g = key``, null where it has none."""
    least = max(n_words // HOT, 1)  # counts add up to n_words, so at most HOT exceed this
    values = table.columns[1:]
    keyed, table = rows.withColumn("key", key), table.withColumnRenamed("g", "key")
    near = keyed.join(F.broadcast(table.filter(F.col("c") > least)), "key", "left")
    far = near.filter("c is null").drop(*values).join(table.filter(F.col("c") <= least), "key", "left")
    return near.filter("c is not null").unionByName(far).drop("key")


def count_tables(grams: DataFrame, order: int, n_words: int, n_docs: int) -> list[DataFrame]:
    """Tables of orders 1 to ``order``: ``g, c`` and, from order 2 on, ``before`` (the count of the context).

    From order 2 on they hold the n-grams that occur twice or more.
    """
    times = f"own{order}"
    marks = grams.sparkSession.range(1).select(*[F.lit(BEGIN).cast("long").alias(w) for w in words_of(order)])
    tables = [stored(grams.groupBy(gram(1).alias("g")).agg(F.sum(times).alias("c")), "lm-1-grams")]
    for k in range(2, order + 1):
        counted = grams.groupBy(gram(k).alias("g")).agg(
            F.sum(times).alias("count"), F.first(gram(k - 1, skip=1)).alias("context")).filter("count > 1")
        begin = marks.select(gram(k - 1).alias("g"), F.lit(n_docs).cast("long").alias("c"))
        contexts = tables[-1].select("g", "c").unionByName(begin)
        tables.append(stored(
            _with_counts(counted, F.col("context"), contexts, n_words + n_docs)
            .select("g", F.col("count").alias("c"), F.col("c").alias("before")), f"lm-{k}-grams"))
    return tables


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers, their first bytes first, then the second ones and so on, compressed."""
    import pyarrow as pa

    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int, kind=np.int64) -> np.ndarray:
    import pyarrow as pa

    planes = np.frombuffer(pa.decompress(packed, 8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _runs(starts: np.ndarray, n: int) -> np.ndarray:
    """Lengths of the runs that begin at ``starts`` among ``n`` values."""
    return np.diff(starts, append=n)


def _distinct_of(grams: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct values in order, their counts, the place of every value among them, and its count in its document."""
    n = len(grams)
    order = np.argsort(grams, kind="stable")  # keeps documents together
    ranked, of = grams[order], doc[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first = np.flatnonzero(new)
    place, own = np.empty(n, np.int32), np.empty(n, np.int32)
    place[order] = np.cumsum(new) - 1
    new[1:] |= of[1:] != of[:-1]
    times = _runs(np.flatnonzero(new), n)
    own[order] = np.repeat(times, times)
    return ranked[first], _runs(first, n), place, own


def blocks(texts: DataFrame, split: bool = False) -> DataFrame:
    """Rows of ``texts`` (``doc, text``) packed: the ``docs`` and numbers of words ``lengths`` of texts, and ``words``.

    Texts without words are left out.  Neighbouring rows of a document come
    into the same block; if ``split``, a block has rows of one document only
    and a document any number of blocks.
    """
    import pyarrow as pa

    schema = "docs array<long>, lengths array<long>, words binary, n_bytes long, split boolean"

    def pack(batches):
        docs, lengths, texts, n = [], [], [], 0

        def block():
            raw = b" ".join(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([docs], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                 pa.array([pa.compress(raw, codec="zstd", asbytes=True)], pa.binary()),
                 pa.array([len(raw)], pa.int64()), pa.array([split])],
                ["docs", "lengths", "words", "n_bytes", "split"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()
                if not words:
                    continue
                if docs and (n >= BLOCK_WORDS and split or doc != docs[-1] and (n >= BLOCK_WORDS or split)):
                    yield block()
                    docs, lengths, texts, n = [], [], [], 0
                docs.append(doc)
                lengths.append(len(words))
                texts.append(b" ".join(words))
                n += len(words)
        if docs:
            yield block()

    return texts.mapInArrow(forgetting(pack), schema)


class Block:
    """The words of a block and what is known of their n-grams."""

    def __init__(self, row: dict, order: int):
        import pyarrow as pa
        import pyarrow.compute as pc

        raw = pa.decompress(row["words"], row["n_bytes"], codec="zstd", asbytes=True)
        words = pc.split_pattern(pa.array([raw], pa.binary()), " ").flatten().dictionary_encode()
        self.words = words.indices.to_numpy()
        hashes = np.fromiter(((xxhash.xxh3_64_intdigest(w) >> 2) | 2 for w in words.dictionary.to_pylist()),
                             np.uint64, len(words.dictionary))
        self.keys = _mix(hashes)
        self.order, self.split = order, row["split"]
        docs, lengths = np.array(row["docs"], np.int64), np.array(row["lengths"], np.int64)
        self.first = np.cumsum(lengths) - lengths  # words that begin a text
        new = np.ones(len(docs), bool)
        new[1:] = docs[1:] != docs[:-1]
        self.docs, self.doc_starts = docs[new], self.first[new]
        self.doc = np.repeat((np.cumsum(new) - 1).astype(np.int32), lengths)

        marks = order - 1
        at = np.arange(len(self.words)) + np.repeat(np.arange(1, len(docs) + 1) * marks, lengths)
        self.padded = np.full(len(self.words) + len(docs) * marks, BEGIN, np.uint64)
        self.padded[at] = hashes[self.words]
        self.at = at
        self.grams = [self.padded[at]]
        #: By order: counts of the n-gram that ends at a word, and in the word's document.
        self.counts: list[np.ndarray] = []
        self.own: list[np.ndarray] = []

    def before(self, values: np.ndarray, at_first) -> np.ndarray:
        """Of every word, the value of the word before; ``at_first`` at the beginning of a text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.first] = at_first
        return out

    def distinct(self, k: int):
        """``words, keys, counts, place, own`` of the n-grams of order ``k`` that can be in other documents."""
        if k == 1:
            rank = np.argsort(self.keys, kind="stable")
            back = np.empty(len(rank), np.int32)
            back[rank] = np.arange(len(rank))
            place = back[self.words]
            return slice(None), self.keys[rank], np.bincount(place, minlength=len(rank)), place, 0
        while len(self.grams) < k:
            self.grams.append(_mix(_mix(self.grams[-1]) ^ self.padded[self.at - len(self.grams)]))
        if k == 2:
            words = slice(None)
        else:
            elsewhere = self.counts[k - 2] > self.own[k - 2]
            words = np.flatnonzero(elsewhere & self.before(elsewhere, True))
        return words, *_distinct_of(self.grams[k - 1][words], self.doc[words])

    def private(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys mixed with the document's, in order, and their order."""
        mixed = _mix(_mix(keys) ^ self.docs.view(np.uint64)[0])
        rank = np.argsort(mixed, kind="stable")
        return mixed[rank], rank

    def learn(self, k: int, replies: dict[int, np.ndarray]) -> None:
        """Take the counts in other blocks of order ``k``; ``-k`` has those in the document's other blocks."""
        words, keys, counts, place, own = self.distinct(k)
        total = np.zeros(len(self.words), np.int64)
        mine = np.zeros(len(self.words), np.int32)
        total[words] = (counts + replies.get(k, 0))[place]
        if self.split and k > 1:
            here = counts.copy()
            here[self.private(keys)[1]] += replies.get(-k, 0)
            own = here[place]
        mine[words] = own
        self.counts.append(total)
        self.own.append(mine)

    def to_send(self, k: int):
        """``kind, keys, counts``: kind ``k`` for the n-grams of order ``k``, ``-k`` for a part of a document's."""
        _, keys, counts, _, _ = self.distinct(k)
        yield k, keys, counts
        if self.split and k > 1:
            private, rank = self.private(keys)
            yield -k, private, counts[rank]

    def scores(self, n_words: int, n_docs: int) -> np.ndarray:
        """Scores of the documents, in millionths."""
        value, left, weight = np.zeros(len(self.words), np.int64), np.ones(len(self.words), bool), 1.0
        for k in range(self.order, 1, -1):
            others = self.counts[k - 1] - self.own[k - 1]
            found = np.flatnonzero(left & (others > 0))
            context = self.before(self.counts[k - 2], n_docs)
            value[found] = _micro(weight * (others[found] / context[found]))
            left[found] = False
            weight *= BACKOFF
        value[left] = _micro(weight * (self.counts[0][left] / n_words))
        return np.add.reduceat(value, self.doc_starts)


def _micro(x: np.ndarray) -> np.ndarray:
    return np.rint(1e6 * np.log10(x)).astype(np.int64)


def _of_blocks(use, order: int):
    """An Arrow map of rows of blocks with their ``replies`` to the batches that ``use(number, block)`` gives.

    A block is given up before the next one is made.
    """
    def known(row: dict) -> Block:
        block = Block(row, order)
        replies: dict[int, list[np.ndarray]] = {}
        for r in sorted(row["replies"] or (), key=lambda r: r["part"]):
            replies.setdefault(r["kind"], []).append(_unpacked(r["elsewhere"], r["n"]))
        joined = {kind: np.concatenate(parts) for kind, parts in replies.items()}
        for k in range(1, row["known"] + 1):
            block.learn(k, joined)
        return block

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from use(row["block"], known(row))

    return forgetting(run)


def sent(known: DataFrame, order: int, orders: list[int], n_parts: int) -> DataFrame:
    """``block, kind, part, n, keys, counts``: the distinct n-grams of blocks by ranges of hashes."""
    import pyarrow as pa

    columns = ["block", "kind", "part", "n", "keys", "counts"]
    bounds = np.array([(p << 64) // n_parts for p in range(1, n_parts)], np.uint64)

    def use(number, block):
        for kind, keys, counts in (x for k in orders for x in block.to_send(k)):
            cuts = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
            rows = [(number, kind, p, b - a, _packed(np.diff(keys[a:b], prepend=np.uint64(0))),
                     _packed(counts[a:b])) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], columns)

    return known.mapInArrow(_of_blocks(use, order), "block long, kind long, part long, n long, keys binary, counts binary")


def counted(rows: DataFrame) -> DataFrame:
    """``block, kind, part, n, elsewhere``: of :func:`sent` n-grams, in order, the counts in other blocks."""
    import pyarrow as pa

    def count(table):
        out = []
        kinds = table.column("kind").to_numpy()
        for kind in np.unique(kinds):
            own = table.filter(pa.array(kinds == kind)).to_pylist()
            counts = [_unpacked(r["counts"], r["n"]) for r in own]
            keys = np.concatenate([np.cumsum(_unpacked(r["keys"], r["n"], np.uint64), dtype=np.uint64) for r in own])
            order = np.argsort(keys, kind="stable")
            ranked = keys[order]
            new = np.ones(len(ranked), bool)
            new[1:] = ranked[1:] != ranked[:-1]
            every, first = np.concatenate(counts), np.flatnonzero(new)
            total = np.empty_like(every)
            total[order] = np.repeat(np.add.reduceat(every[order], first), _runs(first, len(ranked)))
            cuts = np.cumsum([r["n"] for r in own])[:-1]
            out += [(r["block"], int(kind), r["part"], r["n"], _packed(elsewhere))
                    for r, elsewhere in zip(own, np.split(total - every, cuts))]
        return pa.table([pa.array(c) for c in zip(*out)], names=["block", "kind", "part", "n", "elsewhere"])

    return rows.groupBy("part").applyInArrow(count, "block long, kind long, part long, n long, elsewhere binary")


def _with_replies(packed: DataFrame, replies: list[DataFrame], known: int) -> DataFrame:
    """``packed`` blocks with the orders that are ``known``, and the ``replies`` of these."""
    if not replies:
        kind = "array<struct<kind: long, part: long, n: long, elsewhere: binary>>"
        return packed.select("*", F.lit(known).alias("known"), F.lit(None).cast(kind).alias("replies"))
    every = replies[0]
    for part in replies[1:]:
        every = every.unionByName(part)
    every = every.groupBy("block").agg(F.collect_list(F.struct("kind", "part", "n", "elsewhere")).alias("replies"))
    return packed.join(every, "block", "left").select(*packed.columns, F.lit(known).alias("known"), "replies")


def scored(known: DataFrame, order: int, n_words: int, n_docs: int) -> DataFrame:
    """``doc, value``: scores in millionths of the documents of blocks; some documents have several."""
    import pyarrow as pa

    def use(_, block):
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.docs), pa.array(block.scores(n_words, n_docs))], ["doc", "value"])

    return known.mapInArrow(_of_blocks(use, order), "doc long, value long")


def stupid_backoff(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3) -> DataFrame:
    """``id_col, n_words, log_score, mean_score`` for every row.

    ``log_score`` is the sum, ``mean_score`` the mean per word (null without
    words), both log10, of the model of ``order`` 2 or more counted over all
    rows.  Words are runs without ASCII white space.  Null, empty and blank
    texts have 0 words and score 0.  Rows that repeat an id are one document:
    each gets the score of all their words, and the end of one row is not the
    context of the next.  A null id is known by its text.  A text of any length
    is one task's arrays of its words; rows of one id are spread over tasks if
    they have many.  An empty table gives an empty result;
    other columns are not read; ids are integers.
    """
    if order < 2:
        raise ValueError("order is 2 or more")
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text))
    texts = docs.select(key.alias("doc"), text.alias("text"))
    rows = stored(docs.select(F.col(id_col).alias("id"), key.alias("doc"),
                              F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n")), "lm-docs")
    n_words, n_docs = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    repeated = stored(rows.groupBy("doc").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("words"))
                      .filter("rows > 1").select("doc", (F.col("words") > BLOCK_WORDS).alias("long")), "lm-repeated")
    n_repeated = repeated.count()
    packed = blocks(texts)
    if n_repeated:
        several = F.broadcast(repeated) if n_repeated <= BROADCAST_IDS else repeated
        together = texts.join(several.filter("not long"), "doc", "left_semi").repartition("doc")
        packed = blocks(texts.join(several, "doc", "left_anti")) \
            .unionByName(blocks(together.sortWithinPartitions("doc"))) \
            .unionByName(blocks(texts.join(several.filter("long"), "doc", "left_semi")
                                .sortWithinPartitions("doc"), split=True))
    packed = stored(packed.withColumn("block", F.monotonically_increasing_id()), "lm-blocks")

    n_parts = max(n_words // PART_WORDS, LEAST_PARTS)
    replies: list[DataFrame] = []
    for orders in [[1, 2], *[[k] for k in range(3, order + 1)]]:
        known = _with_replies(packed, replies, orders[0] - 1)
        replies.append(stored(counted(sent(known, order, orders, n_parts)), f"lm-{orders[-1]}-counts"))
    summed = stored(scored(_with_replies(packed, replies, order), order, n_words, n_docs)
                    .groupBy("doc").agg(F.sum("value").alias("score")), "lm-scores")
    for table in (packed, *replies, repeated):
        discard(table)

    words = rows.groupBy("doc").agg(F.sum("n").alias("words"))
    return rows.join(words, "doc").join(summed, "doc", "left").select(
        F.col("id").alias(id_col), F.col("words").alias("n_words"),
        (F.coalesce("score", F.lit(0)) / 1e6).alias("log_score"),
        F.when(F.col("words") > 0, F.round(F.col("score") / 1e6 / F.col("words"), 6)).alias("mean_score"))
