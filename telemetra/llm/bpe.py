"""Byte-level BPE with a two-tier lookup (operator 3).

Tier one is a minimal perfect hash over the vocabulary that resolves a whole
pre-token in one probe.  Pre-tokens that are no token themselves go to tier
two: their bytes form a linked list, a heap holds the adjacent pairs that are
tokens, and the pair of lowest rank (leftmost among equals) is merged until
none is left, in O(n log n) for a pre-token of n bytes.

The driver reads the rank file and builds the hash; tasks get both in a
broadcast variable whose size is that of the vocabulary.  Work per document
is local, so there is no shuffle.
"""

from __future__ import annotations

import base64
import uuid
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame

from telemetra.llm.common import Remembered, forget_others, forgetting

#: Token ids that a task passes on in one batch, unless a single text has more.
BATCH_IDS = 500_000


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of ``base64 rank`` lines; ranks are 0 .. n-1."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """Minimal perfect hash of ``keys`` by hash and displace; slots hold key numbers.

    Keys fall into buckets, two to a bucket on average.  Buckets of two keys
    and more get, largest first, a displacement that sends their keys to free
    slots; a lone key's bucket names its slot directly (negative entry).
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.n_buckets = max(1, n // 2)
        shift = np.zeros(self.n_buckets, np.int64)
        slot = np.full(max(n, 1), -1, np.int64)
        buckets: dict[int, list[int]] = {}
        for i, key in enumerate(keys):
            buckets.setdefault(xxhash.xxh3_64_intdigest(key) % self.n_buckets, []).append(i)
        order = sorted(buckets, key=lambda b: -len(buckets[b]))
        free = np.ones(n, bool)
        for b in order:
            own = buckets[b]
            if len(own) == 1:
                break
            d = 1
            while True:
                at = [xxhash.xxh3_64_intdigest(keys[i], d) % n for i in own]
                if len({*at}) == len(at) and free[at].all():
                    break
                d += 1
            shift[b] = d
            slot[at] = own
            free[at] = False
        left = iter(np.nonzero(free)[0].tolist())
        for b in order:
            if len(buckets[b]) == 1:
                at = next(left)
                shift[b] = -at - 1
                slot[at] = buckets[b][0]
        self.shift, self.slot = shift.tolist(), slot.tolist()  # lists are read faster one by one

    def candidate(self, key: bytes) -> int:
        """The only key number that ``key`` can have; the caller compares the keys."""
        d = self.shift[xxhash.xxh3_64_intdigest(key) % self.n_buckets]
        if d == 0:
            return -1
        return self.slot[-d - 1 if d < 0 else xxhash.xxh3_64_intdigest(key, d) % self.n]


def byte_pairs(ranks: dict[bytes, int]) -> list[list[int]]:
    """Ranks of all two-byte tokens by first and second byte, -1 for others."""
    return [[ranks.get(bytes((first, second)), -1) for second in range(256)] for first in range(256)]


def merge_pairs(piece: bytes, ranks: dict[bytes, int], twos: list[list[int]]) -> list[int]:
    """Ids of one pre-token by rank-ordered merges (heap over linked bytes).

    ``twos`` is :func:`byte_pairs` of the ranks.  A heap entry holds a rank
    above the bits of a start; it is stale unless ``pair[start]`` still has
    that rank.
    """
    n = len(piece)
    bits = n.bit_length()
    mask = (1 << bits) - 1
    get = ranks.get
    end = [*range(1, n + 1)]  # of the part that starts here
    before = [*range(-1, n)]  # start of the part before
    pair = [twos[a][b] for a, b in zip(piece, piece[1:])]
    pair.append(-1)
    merged = {}  # rank of the part that starts here, if longer than a byte
    heap = [r << bits | i for i, r in enumerate(pair) if r >= 0]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        i = entry & mask
        rank = entry >> bits
        if pair[i] != rank:
            continue
        merged[i] = rank
        j = end[i]
        stop = end[i] = end[j]
        pair[j] = -1
        before[stop] = i
        if stop < n:
            r = pair[i] = get(piece[i:end[stop]], -1)
            if r >= 0:
                heappush(heap, r << bits | i)
        else:
            pair[i] = -1
        h = before[i]
        if h >= 0:
            r = pair[h] = get(piece[h:stop], -1)
            if r >= 0:
                heappush(heap, r << bits | h)
    out, i = [], 0
    while i < n:
        out.append(merged[i] if i in merged else ranks[piece[i:i + 1]])
        i = end[i]
    return out


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, tokens: list[bytes], table: PerfectHash, pattern: str):
        self.tokens, self.table = tokens, table
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.apart = regex.compile(r"\s\s|^\s|\s$").search
        self.twos = byte_pairs(self.ranks)
        self.packed = [array("i", [i]).tobytes() for i in range(len(tokens))]
        self.pieces = Remembered(self.pre_token)
        self.words = Remembered(lambda word: self.pre_token(" " + word) if word.isalpha()
                                else self.pre_tokens(" " + word))

    def pre_token(self, piece: str) -> bytes:
        """Ids of one pre-token as packed 32-bit integers, which take less room than tuples."""
        raw = piece.encode()
        i = self.table.candidate(raw)
        if i >= 0 and self.tokens[i] == raw:
            return self.packed[i]
        return array("i", merge_pairs(raw, self.ranks, self.twos)).tobytes()

    def pre_tokens(self, text: str) -> bytes:
        """Ids of the pre-tokens of a text; a blank and letters are remembered as a word."""
        return b"".join([self.words[piece[1:]] if piece[0] == " " and piece[1:].isalpha() else self.pieces[piece]
                         for piece in self.split(text)])

    def encode_packed(self, text: str | None) -> bytes:
        """Token ids of a whole text as packed 32-bit integers, no special tokens.

        A blank between two characters that are no white space always begins a
        pre-token, so a text without other blanks is encoded word by word.
        """
        if not text:
            return b""
        self.pieces.trim()
        self.words.trim()
        if self.apart(text):
            return self.pre_tokens(text)
        first, *rest = text.split(" ")
        return self.pre_tokens(first) + b"".join(map(self.words.__getitem__, rest))

    def encode(self, text: str) -> list[int]:
        """Token ids of a whole text."""
        return array("i", self.encode_packed(text)).tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encoded_batches(own: Codec, batch):
    """Batches ``id, ids`` of a batch ``id, text``, of ``BATCH_IDS`` ids at most or of one text."""
    import pyarrow as pa

    def passed_on(first, ids):
        ends = np.cumsum([0, *map(len, ids)]) // 4
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
        return pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(ids)), lists], ["id", "ids"])

    first, ids, held = 0, [], 0
    for row, text in enumerate(batch.column(1)):
        packed = own.encode_packed(text.as_py())
        if ids and held + len(packed) > 4 * BATCH_IDS:
            yield passed_on(first, ids)
            first, ids, held = row, [], 0
        ids.append(packed)
        held += len(packed)
    if ids:
        yield passed_on(first, ids)


def decoded_batches(own: Codec, batch):
    """Batches ``id, ids, decoded`` of a batch ``id, ids``, of ``BATCH_IDS`` ids at most or of one row."""
    import pyarrow as pa

    lists = batch.column(1)
    values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    valid = lists.is_valid().to_pylist()
    first = 0
    while first < len(valid):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + BATCH_IDS, "right")) - 1)
        out = [own.decode(values[a:b].tolist() if ok else ())
               for a, b, ok in zip(ends[first:last], ends[first + 1:last + 1], valid[first:last])]
        rows = batch.slice(first, last - first)
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(out, pa.binary())], ["id", "ids", "decoded"])
        first = last


_codecs: dict[str, Codec] = {}


class Tokenizer:
    """A vocabulary on the cluster; ``encode`` and ``decode`` are operators."""

    def __init__(self, spark, path: str, pattern: str):
        tokens = read_ranks(path)
        self.key = uuid.uuid4().hex
        self.shared = spark.sparkContext.broadcast((tokens, PerfectHash(tokens), pattern))

    def _codec(self):
        key, shared = self.key, self.shared

        def codec() -> Codec:
            """A worker makes its codec once and keeps it between tasks."""
            if key not in _codecs:
                _codecs.clear()
                _codecs[key] = Codec(*shared.value)
            forget_others(_codecs[key].words, _codecs[key].pieces)
            return _codecs[key]
        return codec

    def encode(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``id_col, ids`` (array of int) for every row.

        A null or empty text gives an empty array.  Rows that repeat an id stay
        separate rows; an empty table gives an empty result; other columns are
        not read.
        """
        codec = self._codec()
        kind = dict(docs.dtypes)[id_col]

        def run(batches):
            own = codec()
            for batch in batches:
                yield from encoded_batches(own, batch)

        return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")) \
            .mapInArrow(forgetting(run), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)

    def decode(self, encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
        """``encoded`` columns ``id_col, ids_col`` and ``decoded`` (the bytes of the ids).

        A null array gives empty bytes; an id outside the vocabulary raises.
        """
        codec = self._codec()
        kind = dict(encoded.dtypes)[id_col]

        def run(batches):
            own = codec()
            for batch in batches:
                yield from decoded_batches(own, batch)

        return encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids")) \
            .mapInArrow(forgetting(run), f"id {kind}, ids array<int>, decoded binary") \
            .withColumnsRenamed({"id": id_col, "ids": ids_col})
