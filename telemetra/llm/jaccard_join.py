"""N-gram Jaccard join by a token-group matrix (operator 4).

A document is the set of hashes of its distinct word shingles.  Documents with
equal sets form a class; one representative of each goes on.

*Index.*  Two sets of Jaccard similarity t or more share one of the first
``n - ceil(t n) + 1`` tokens of each under any common order of tokens.  Those
prefixes (hash order, and a few tokens more) are exchanged once by token; only
tokens that several representatives hold are kept.  Frequent tokens are then
moved to the end of the order, which takes common passages out of the
prefixes; a document whose stored tokens do not reach that far keeps the plain
hash order for all its pairs.

*Groups.*  Every token points to one of its holders, the one whose tokens are
the most widely held (the original of a cluster of edited copies).  Documents
that point to the same one are a group; each is tried against it, and verified
links make the first components.

*Matrix.*  For every group the union of its members' prefix tokens is stored,
one row per token and group.  A document is a query against larger groups:
the number of its prefix tokens in a group's union bounds its overlap with any
member, and only groups that the bound admits are opened: the query's full set
is sent to each part of the group and compared with the members there that are
not yet in its component.  Within a group the same is done for the members
outside its main component.  Documents that keep the hash order are taken
together by a common frequent token, and every document is a query against
these groups.

Neither copies nor groups are expanded into pairs, and nothing is capped or
sampled: the result is exact (up to 64-bit hashes).
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.common import BROADCAST_IDS, Remembered, forget_others, forgetting, slices, stored, without
from telemetra.llm.components import components

WORDS = 5
#: Similarity as a fraction: links hold when intersection / union >= NUM / DEN.
NUM, DEN = 3, 4
#: Stored tokens beyond the prefix: at least SLACK, or SLACK_PERCENT of the set.
SLACK, SLACK_PERCENT = 64, 3
#: A token with more holders goes to the end of the order (a matter of cost, not of the result).
FREQUENT = 64
#: Parts among which the tries against one document are dealt.
SALTS = 16
#: Members of a group that are held together when it is opened.
PART = 256

_word_hash = Remembered(xxhash.xxh3_64_intdigest, room=60_000)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                     0xA0761D6478BD642F], np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text.

    Words are runs without ASCII white space, A-Z lower-cased.  Fewer than
    ``WORDS`` words are one shingle; no words, none.
    """
    words = text.encode().lower().split() if text else []
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)] if words else [], np.uint64)
    _word_hash.trim()
    h = np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words))
    n = len(h) - WORDS + 1
    with np.errstate(over="ignore"):
        s = h[:n] * _FACTORS[0]
        for k in range(1, WORDS):
            s += h[k:n + k] * _FACTORS[k]
        s = (s ^ (s >> np.uint64(31))) * _FACTORS[1]
    return np.unique(s ^ (s >> np.uint64(29)))


def _prefix(n):
    """Length of the prefix for a set of n tokens (works on numbers and columns)."""
    return n - (NUM * n + DEN - 1) // DEN + 1


def _stored_tokens(n: int) -> int:
    return min(n, _prefix(n) + max(SLACK, n * SLACK_PERCENT // 100))


def _only(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The documents with one of ``ids``: broadcast when they are few, else a shuffle join."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs[id_col] == ids["id"], "left_semi")


class _Part:
    """The members of one part of a group: their sets, and the components they are known to be in."""

    def __init__(self):
        self.sets: list[np.ndarray] = []
        self.components: list[int] = []
        self.every = None

    def add(self, tokens: np.ndarray, component: int) -> None:
        self.sets.append(tokens)
        self.components.append(component)

    def linked(self, tokens: np.ndarray, component: int) -> set[int]:
        """Components of members, other than the query's own, whose sets reach the similarity."""
        if self.every is None:
            self.sizes = np.array([len(x) for x in self.sets])
            self.starts = np.cumsum(self.sizes) - self.sizes
            self.labels = np.array(self.components)
            self.every = np.concatenate(self.sets)
        n = len(tokens)
        open_ = (self.labels != component) & (DEN * np.minimum(self.sizes, n) >= NUM * np.maximum(self.sizes, n))
        if not open_.any():
            return set()
        at = np.minimum(np.searchsorted(tokens, self.every), n - 1)
        common = np.add.reduceat((tokens[at] == self.every).astype(np.int64), self.starts)
        return set(self.labels[open_ & (DEN * common >= NUM * (self.sizes + n - common))].tolist())


def verified(docs: DataFrame, members: DataFrame, queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``a, b``: components that are linked, by comparing queries with the members of groups.

    ``members`` and ``queries`` are ``grp, part, id, comp``.  The full sets of
    a part's members (``PART`` of them or so) are held while its queries pass
    one by one; members of a query's own component are passed over.
    """
    import pyarrow as pa

    wanted = stored(members.select("grp", "part", F.lit(0).alias("role"), "id", "comp").unionByName(
        queries.select("grp", "part", F.lit(1).alias("role"), "id", "comp")), "jaccard-meetings")
    ids = stored(wanted.select("id").distinct(), "jaccard-ids")

    def full(batches):
        for batch in batches:
            sets = [shingles(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "tokens"])

    sets = stored(_only(docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text")),
                        "key", ids).mapInArrow(forgetting(full), "id long, tokens binary"), "jaccard-sets")

    def compare(batches):
        at, own = None, None
        for batch in batches:
            found = set()
            for grp, part, role, comp, tokens in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if (grp, part) != at:
                    at, own = (grp, part), _Part()
                tokens = np.frombuffer(tokens, np.uint64)
                if role == 0:
                    own.add(tokens, comp)
                elif own.sets:
                    found.update((other, comp) for other in own.linked(tokens, comp))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.int64())], ["a", "b"])

    return wanted.join(sets.hint("merge"), "id").select("grp", "part", "role", "comp", "tokens") \
        .repartition("grp", "part").sortWithinPartitions("grp", "part", "role") \
        .mapInArrow(compare, "a long, b long").distinct()


def _index(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``token, doc, n, pos``: the stored prefix tokens that several rows hold, with ``holders``."""
    import pyarrow as pa

    def prefixes(batches):
        forget_others(_word_hash)
        for batch in slices(batches):
            tokens, doc, n, pos = [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = shingles(text.as_py())
                kept = _stored_tokens(len(s)) if len(s) else 0
                tokens.append(s[:kept].view(np.int64))
                doc.append(np.full(kept, key, np.int64))
                n.append(np.full(kept, len(s), np.int32))
                pos.append(np.arange(kept, dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, doc, n, pos)],
                                                 ["token", "doc", "n", "pos"])

    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text")) \
        .filter("key is not null").mapInArrow(forgetting(prefixes), "token long, doc long, n int, pos int")
    return rows.withColumn("holders", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("holders > 1")


def _lengths(n):
    """Columns: prefix and stored tokens of a set of ``n``."""
    p = n - F.ceil(NUM * n / DEN) + 1
    return p, F.least(n, p + F.greatest(F.lit(SLACK), F.floor(n * SLACK_PERCENT / 100)))


def _ordered(index: DataFrame, groups: DataFrame) -> DataFrame:
    """``token, doc, n, grp, members, plain, late, fits, kin``: which tokens are in the prefix of which order.

    ``late``: in the prefix of the order with frequent tokens last; only where
    the stored tokens reach that far (``fits``).  ``plain``: in the prefix of
    the hash order.  A pair is found in the late order if both fit, else in
    the plain order.  A token is frequent when many groups hold it; tokens
    that a single component holds have done their work.  ``kin``: a document
    that does not fit consists of common passages in large part; those whose
    least hashed frequent token is the same are taken together.
    """
    by_token = Window.partitionBy("token")
    held = index.join(groups.select("doc", "grp", "comp", "members"), "doc") \
        .withColumn("nth", F.dense_rank().over(by_token.orderBy("grp"))) \
        .withColumn("groups", F.max("nth").over(by_token)) \
        .withColumn("open", F.min("comp").over(by_token) != F.max("comp").over(by_token)).filter("open")
    per_doc = Window.partitionBy("doc")
    p, length = _lengths(F.col("n"))
    marked = held.withColumn("often", F.when(F.col("groups") > FREQUENT, 1).otherwise(0)) \
        .withColumn("earlier", F.coalesce(F.sum("often").over(
            per_doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("seldom", length - F.sum("often").over(per_doc)) \
        .withColumn("kin", F.min(F.when(F.col("often") == 1, F.xxhash64("token"))).over(per_doc)) \
        .withColumn("p", p).withColumn("whole", length == F.col("n"))
    rank = F.when(F.col("often") == 1, F.when(F.col("whole"), F.col("seldom") + F.col("earlier"))) \
        .otherwise(F.col("pos") - F.col("earlier"))
    return marked.withColumn("fits", F.col("whole") | (F.col("seldom") >= F.col("p"))).select(
        "token", "doc", "n", "grp", "members", "fits", "kin", (F.col("pos") < F.col("p")).alias("plain"),
        F.coalesce(F.col("fits") & (rank < F.col("p")), F.lit(False)).alias("late")).filter("plain or late")


def _close(a: str, b: str):
    """Sizes that allow the similarity."""
    return DEN * F.least(a, b) >= NUM * F.greatest(a, b)


def _tries(index: DataFrame) -> DataFrame:
    """``grp, part, id``: at most one try per document, against the holder that most of its tokens point to.

    A token points to its holder of most weight, the mean number of holders of
    a document's stored tokens; in a cluster of edited copies that is the
    original or the least edited one.
    """
    p, length = _lengths(F.col("n"))
    listed = stored(index.withColumn("weight", F.sum("holders").over(Window.partitionBy("doc")) / length)
                    .filter(F.col("pos") < p).select("token", "doc", "n", "weight"), "jaccard-weights")
    heads = stored(listed.groupBy("token").agg(F.max(F.struct("weight", F.xxhash64("doc"), F.col("doc").alias("head"),
                                                              F.col("n").alias("head_n"))).alias("m"))
                   .select("token", "m.head", "m.head_n"), "jaccard-heads")
    counted = listed.select("token", "doc", "n").join(heads.hint("merge"), "token") \
        .filter((F.col("doc") != F.col("head")) & _close("n", "head_n")) \
        .groupBy("doc", "head", "n").agg(F.count(F.lit(1)).alias("c")).filter("8 * c >= n")
    return counted.groupBy("doc").agg(F.max(F.struct("c", "head")).alias("m")).select(
        F.col("m.head").alias("grp"), F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int").alias("part"),
        F.col("doc").alias("id"))


def _admitted(hits: DataFrame, unit: str) -> DataFrame:
    """``doc, unit``: the queries and units that the bound admits.

    Of a pair with sizes x and y, the overlap is at most the common prefix
    tokens plus what either set has beyond its prefix, so these must number
    ``ceil(t (x + y) / (1 + t)) - max(ceil(t x), ceil(t y)) + 1`` at least.
    For given x that is least at one end of the range of y.
    """
    def need(y):
        n = F.col("n")
        most = F.greatest(F.ceil(NUM * n / DEN), F.ceil(NUM * y / DEN))
        return F.ceil(NUM * (n + y) / (NUM + DEN)) - most + 1

    found = hits.filter((DEN * F.col("high") >= NUM * F.col("n")) & (DEN * F.col("n") >= NUM * F.col("low"))) \
        .groupBy("doc", "n", unit).agg(F.count(F.lit(1)).alias("c"), F.min("low").alias("low"),
                                       F.max("high").alias("high"))
    low = F.greatest("low", F.ceil(NUM * F.col("n") / DEN))
    high = F.least("high", F.floor(DEN * F.col("n") / NUM))
    # one token less than the bound, since the ends are rounded
    return found.filter((low <= high) & (F.col("c") >= F.least(need(low), need(high)) - 1)).select("doc", unit)


def _qualifying(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables of queries and what their bound admits: ``doc, grp`` and ``doc, kin``.

    Documents that fit are queries against larger groups than their own, by
    the members that fit.  Pairs of which one document does not fit are found
    by all documents as queries against the kins of those that do not.
    """
    union = [F.min("n").alias("low"), F.max("n").alias("high")]
    late = rows.filter("late and fits")
    by_group = late.groupBy("token", F.col("grp").alias("g")).agg(*union, F.max("members").alias("g_members"))
    by_kin = rows.filter("plain and not fits").groupBy("token", F.col("kin").alias("k")).agg(*union)
    larger = late.join(by_group, "token").filter(F.struct("g_members", "g") > F.struct("members", "grp"))
    return (_admitted(larger, "g").withColumnRenamed("g", "grp"),
            _admitted(rows.filter("plain").join(by_kin, "token"), "k").withColumnRenamed("k", "kin"))


def row_components(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``row, id, n, component``.

    ``row_col`` has distinct numbers of the rows of ``docs``, a written table.
    Every row is a document of its own, whatever its id; ``component`` is the
    smallest row number that is reachable by links.
    """
    import pyarrow as pa

    def summaries(batches):
        forget_others(_word_hash)
        for batch in slices(batches):
            sizes, digests = [], []
            for text in batch.column(2):
                s = shingles(text.as_py())
                sizes.append(len(s))
                digests.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())],
                ["row", "id", "n", "sig"])

    every = stored(docs.select(F.col(row_col).alias("row"), F.col(id_col).cast("long").alias("id"),
                               F.col(text_col).alias("text"))
                   .mapInArrow(forgetting(summaries), "row long, id long, n long, sig binary"), "jaccard-docs")
    classes = stored(every.filter("n > 0").groupBy("sig").agg(F.min("row").alias("rep")), "jaccard-classes")
    member = stored(every.join(classes, "sig", "left").select("row", "id", "n", F.coalesce("rep", "row").alias("rep")),
                    "jaccard-members")
    copies = stored(member.filter("row <> rep").select(F.col("row").alias("id")), "jaccard-copies")

    index = stored(_index(without(docs, row_col, copies), row_col, text_col), "jaccard-index")
    # groups: the documents that point to the same one; components: what is linked so far
    tries = stored(_tries(index), "jaccard-tries")
    heads = tries.select("grp", "part", F.col("grp").alias("id")).distinct().withColumn("comp", F.col("id"))
    links = stored(verified(docs, heads, tries.withColumn("comp", F.col("id")), row_col, text_col), "jaccard-links")
    near = components(links).withColumnsRenamed({"node": "doc", "component": "comp"})
    placed = index.select("doc").distinct().join(tries.select(F.col("id").alias("doc"), "grp"), "doc", "left") \
        .join(near, "doc", "left").select("doc", F.coalesce("grp", "doc").alias("grp"),
                                          F.coalesce("comp", "doc").alias("comp"))
    placed = stored(placed, "jaccard-placed")
    parted = placed.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("grp").agg(
        F.sum("k").alias("members"), F.count(F.lit(1)).alias("comps"), F.max(F.struct("k", "comp")).alias("m"))
    sizes = stored(parted.select("grp", "members", "comps", F.col("m.comp").alias("main")), "jaccard-sizes")
    groups = stored(placed.join(sizes, "grp"), "jaccard-groups")

    # a group is opened to queries from outside, and to its own members outside its main component
    rows = stored(_ordered(index, groups), "jaccard-prefixes")
    by_group, by_kin = _qualifying(rows)
    asked = by_group.join(placed.select("doc", "comp"), "doc").select("doc", "comp", "grp") \
        .union(groups.filter("comps > 1 and comp <> main").select("doc", "comp", "grp"))
    # kins are opened likewise; a group has a number, a kin the hash of a token
    kin = stored(rows.filter("not fits").select("doc", "kin").distinct().join(placed.select("doc", "comp"), "doc"),
                 "jaccard-kin")
    openable = stored(groups.select(F.lit(False).alias("kin"), "grp", "doc", "comp").union(
        kin.select(F.lit(True), "kin", "doc", "comp")), "jaccard-openable")
    held = openable.groupBy("kin", "grp").agg(F.count(F.lit(1)).alias("members"))
    asked = stored(asked.select(F.lit(False).alias("kin"), "grp", "doc", "comp").union(
        by_kin.join(placed.select("doc", "comp"), "doc").select(F.lit(True), "kin", "doc", "comp"))
        .join(held, ["kin", "grp"]), "jaccard-asked")
    parts, name = F.ceil(F.col("members") / PART).cast("int"), F.struct("kin", "grp").alias("grp")
    queries = asked.select(name, F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
                           F.col("doc").alias("id"), "comp")
    opened = openable.join(asked.select("kin", "grp", "members").distinct(), ["kin", "grp"])
    members = opened.select(name, F.pmod(F.xxhash64("doc"), parts).cast("int").alias("part"),
                            F.col("doc").alias("id"), "comp")
    more = stored(verified(docs, members, queries, row_col, text_col), "jaccard-links")
    final = stored(components(links.union(more)), "jaccard-components")
    return stored(member.join(final, member["rep"] == final["node"], "left").select(
        "row", "id", "n", F.coalesce("component", "rep").alias("component")), "jaccard-rows")


def _looked_up(rows: DataFrame, col: str, table: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``table`` (column ``of``), which is broadcast when it is small."""
    table = F.broadcast(table) if table.count() <= BROADCAST_IDS else table.hint("merge")
    return rows.join(table, rows[col] == table["of"], "left")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, n_shingles, component_id``.

    ``component_id`` is the smallest id that is reachable by links, the row's
    own included.  Texts without words (null, empty, blank) link with nothing
    and keep their own id.  Rows that repeat an id are one document: links of
    any of its texts count.  A row with a null id is a document of its own; it
    gets the smallest id among those it is linked with (null when there is
    none).  An empty table gives an empty result; other columns are not read;
    ids are integers.
    """
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                                  F.col(text_col).alias("text")), "jaccard-numbered")
    linked = row_components(numbered, "row", "id", "text")
    # components that share an id are one
    spread = linked.filter("id is not null").groupBy("id").agg(
        F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("id")
    shared = linked.select("id", "component").join(stored(spread, "jaccard-repeated"), "id").distinct()
    shared = stored(shared.join(shared.groupBy("id").agg(F.min("component").alias("a")), "id")
                    .select("a", F.col("component").alias("b")), "jaccard-shared")
    if not shared.isEmpty():
        joined = stored(components(shared).select(F.col("node").alias("of"), F.col("component").alias("whole")),
                        "jaccard-joined")
        linked = stored(_looked_up(linked, "component", joined).select(
            "row", "id", "n", F.coalesce("whole", "component").alias("component")), "jaccard-rows")
    # a component of one row has that row's id
    least = stored(linked.groupBy(F.col("component").alias("of")).agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("of", "least"),
        "jaccard-least")
    return _looked_up(linked, "component", least).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))
