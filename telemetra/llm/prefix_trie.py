"""Prefix trie of conversations by van Emde Boas recursion (operator 13).

A node of the trie is a distinct sequence of first turns; its name is the
smallest conversation that begins with it, and its depth.

*Cutting.*  A unit is the part of the trie between two depths, 2**k apart,
under one node.  It is cut at half its depth: all conversations that reach the
cut are grouped by their turns up to there, and every group is named by its
smallest member.  The groups' members go on into the lower forest under their
name, one representative of each group stays for the upper trie, and both
halves, of all units at once, are the units of the next step.  So the number
of steps is logarithmic in the depth of the trie, copies of a prefix are
carried by one representative with its weight, and no conversation is ever
held whole: turns are compared by fingerprints of aligned runs of 2**k turns,
aggregated once.

*Grafting.*  Sums over subtrees go up the same cuts.  From small units to
large, the sum below a unit's top is that of its upper trie plus those of the
lower tries under its cut nodes; then, from large to small, what hangs below a
unit's bottom nodes is grafted onto them, summed by cut node for the upper
half, until units are single nodes.

Every step is an aggregation or a join on (conversation, unit) with unique
keys, but for handing names back to a group's members, where the group table
is joined by a sort-merge join that Spark can split.  Turns are equal when two
64-bit hashes of role and text are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.common import discard, stored, text_of


def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, pos, f1, f2, chars``: turns numbered from 1 inside their conversation.

    Turns are in order of number (null first), then role, then text; a null
    role or text is empty.  Rows without a conversation are left out.  Numbers
    come from one sort of the table by ranges and from offsets of its
    partitions, so that a conversation of any length is spread over tasks.
    """
    role, text = text_of(role_col), text_of(text_col)
    plain = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        role.alias("role"), text.alias("text"))
    in_order = stored(
        plain.orderBy("conv", F.col("turn").asc_nulls_first(), "role", "text", F.rand(1)).select(
            "conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
            F.xxhash64(F.lit(1), "role", "text").alias("f1"), F.xxhash64(F.lit(2), "role", "text").alias("f2"),
            F.length("text").cast("long").alias("chars")), "turns-in-order")
    # of a conversation's run in each partition: its first place, and the turns in runs before
    runs = in_order.groupBy("conv", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    skip = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    before = runs.withColumn("skip", F.coalesce(skip, F.lit(0)))
    numbered = stored(in_order.join(before, ["conv", "part"]).select(
        "conv", (F.col("place") - F.col("first") + F.col("skip") + 1).alias("pos"), "f1", "f2", "chars"),
        "turns-numbered")
    discard(in_order)
    return numbered


def rebuilt(turns: DataFrame, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Every conversation c begun anew: ``(turns, conversations)`` as :func:`prefix_trie` takes them.

    The first h turns of conversation c - c % 100 (all if it has fewer, none
    if there is no such conversation) come first, then c's own turns after its
    first h; h is crc32 of the decimal c modulo ``most`` + 1.
    """
    h = (F.crc32(F.col("conv").cast("string")) % (most + 1)).cast("long")
    base = F.col("conv") - F.col("conv") % 100
    own = turns.groupBy("conv").agg(F.max("pos").alias("n")).withColumns({"h": h, "base": base})
    convs = stored(own.alias("c").join(own.select(F.col("conv").alias("b"), F.col("n").alias("base_n")),
                                       F.col("base") == F.col("b"), "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("shared"),
        (F.least("h", F.coalesce("base_n", F.lit(0))) + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")),
        "conversations")
    heads = turns.filter(F.col("pos") <= most).withColumnRenamed("conv", "base")
    begun = heads.join(convs.filter("shared > 0").select("conv", "base", "shared"), "base").filter("pos <= shared") \
        .select("conv", "pos", "f1", "f2", "chars")
    rest = turns.join(convs.select("conv", "h", "shared").hint("merge"), "conv").filter("pos > h") \
        .select("conv", (F.col("pos") - F.col("h") + F.col("shared")).alias("pos"), "f1", "f2", "chars")
    return stored(begun.union(rest), "turns-rebuilt"), convs.select("conv", "len")


def _copies(sequences: DataFrame) -> DataFrame:
    """``conv, len, w, ends``: of equal sequences (``conv, len, x1, x2``), the smallest conversation, their
    number, and the digest of all their decimal numbers.

    A digest of an ordered list is one pass over it: equal sequences meet in
    one task, sorted on disk where they must be, and are streamed through it;
    a number is all that is moved of each, and none is held.
    """
    import pyarrow as pa

    def digests(batches):
        key, first, n, sha = None, None, 0, None
        for b in batches:
            out = []
            for conv, *at in zip(*(b.column(k).to_pylist() for k in range(4))):
                if at != key:
                    if key is not None:
                        out.append((first, key[0], n, sha.hexdigest()))
                    key, first, n, sha = at, conv, 0, hashlib.sha256()
                sha.update(b"%d" % conv if n == 0 else b",%d" % conv)
                n += 1
            yield batch(out)
        if key is not None:
            yield batch([(first, key[0], n, sha.hexdigest())])

    def batch(out):
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]),
                                           pa.array(columns[3], pa.string())], ["conv", "len", "w", "ends"])

    return sequences.select("conv", "len", "x1", "x2").repartition("len", "x1", "x2") \
        .sortWithinPartitions("len", "x1", "x2", "conv") \
        .mapInArrow(digests, "conv long, len long, w long, ends string")


def _fingerprints(place) -> list[Column]:
    """Two order-sensitive hashes of a set of turns, by their ``place`` among them."""
    return [F.bit_xor(F.xxhash64(F.lit(k), place, F.col("f1"), F.col("f2"))).alias(f"x{k}") for k in (1, 2)]


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``.

    ``turns`` has ``conv, pos, f1, f2, chars``: the turns of a conversation
    numbered from 1 without gaps, two hashes that tell turns apart, and their
    code points; ``convs`` has ``conv, len`` of every conversation, also of
    those without turns (members of the root only).  Both are stored tables.
    A node's ``conv_id`` is its smallest member; ``n_convs`` counts members,
    ``n_leaves`` the childless nodes of its subtree, ``saved_tokens`` sums
    (members - 1) times code points over it, ``ends_sha256`` digests the
    members that end there.  Without conversations there are no nodes.
    """
    spark = turns.sparkSession
    top = convs.agg(F.min("conv").alias("root"), F.max("len").alias("depth"), F.count(F.lit(1)).alias("n")).first()
    if not top["n"]:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, "
                                         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    height = max(top["depth"], 1).bit_length()  # the unit of 2**height turns reaches below every node

    whole = turns.groupBy("conv").agg(*_fingerprints(F.col("pos")))
    copies = stored(_copies(convs.join(whole, "conv", "left")), "conversation-copies")

    # fingerprints of the upper halves of units, one table for all sizes
    at = turns.select("conv", "f1", "f2", (F.col("pos") - 1).alias("i"),
                      F.explode(F.sequence(F.lit(0), F.lit(height - 1))).alias("k")) \
        .withColumn("u", F.expr("shiftright(i, k)")).filter("u % 2 = 0")
    prints = stored(at.groupBy("k", "conv", "u").agg(
        *_fingerprints(F.expr("i - shiftleft(u, k)")), F.count(F.lit(1)).alias("n"))
        .filter("n = shiftleft(1L, k)").drop("n"), "run-prints")

    # cut every unit at half its depth, name the cut prefixes
    pieces = copies.filter("len > 0").select("conv", F.lit(0).cast("long").alias("u"),
                                             F.lit(top["root"]).cast("long").alias("root"), "w", "len")
    cuts, named = {}, {}
    ends = [copies.filter("len = 0").select(F.lit(top["root"]).cast("long").alias("name"), F.col("len").alias("depth"), "ends")]
    for k in range(height, 0, -1):
        half = 1 << (k - 1)
        upper = prints.filter(F.col("k") == k - 1).select("conv", F.expr("u div 2").alias("u"), "x1", "x2")
        known = stored(pieces.join(upper, ["conv", "u"], "left"), "trie-pieces")
        full = known.filter("x1 is not null")
        groups = stored(full.groupBy("u", "root", "x1", "x2").agg(
            F.min(F.struct("conv", "len")).alias("least"), F.sum("w").alias("w")), "trie-cuts")
        cuts[k] = groups.select(F.col("least.conv").alias("name"), "u", "root")
        members = full.join(groups.select("u", "root", "x1", "x2", F.col("least.conv").alias("cut")).hint("merge"),
                            ["u", "root", "x1", "x2"])
        named[k] = stored(members.select("conv", "u", "cut", "w", "len"), "trie-named")
        mid = (2 * F.col("u") + 1) * half
        ends.append(named[k].filter(F.col("len") == mid).join(copies.select("conv", "ends"), "conv")
                    .select(F.col("cut").alias("name"), F.col("len").alias("depth"), "ends"))
        pieces = known.filter("x1 is null").select("conv", (2 * F.col("u")).alias("u"), "root", "w", "len") \
            .union(groups.select("least.conv", 2 * F.col("u"), "root", "w", "least.len")) \
            .union(named[k].filter(F.col("len") > mid).select("conv", 2 * F.col("u") + 1, "cut", "w", "len"))

    # units of one depth: the nodes
    turn = turns.select("conv", (F.col("pos") - 1).alias("u"), "f1", "f2", "chars")
    nodes = pieces.join(turn, ["conv", "u"]).groupBy("u", "root", "f1", "f2").agg(
        F.min("conv").alias("name"), F.sum("w").alias("n"), F.min("chars").alias("chars")) \
        .select("name", (F.col("u") + 1).alias("depth"), F.col("root").alias("parent"), "n", "chars")
    nodes = stored(nodes.unionByName(spark.range(1).select(
        F.lit(top["root"]).cast("long").alias("name"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"),
        F.lit(top["n"]).cast("long").alias("n"), F.lit(0).cast("long").alias("chars"))), "trie-nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("name"), (F.col("depth") - 1).alias("depth")) \
        .agg(F.count(F.lit(1)).alias("children"))
    valued = stored(nodes.join(children, ["name", "depth"], "left").select(
        "name", "depth", "parent", "n", F.coalesce("children", F.lit(0)).cast("long").alias("children"),
        F.col("children").isNull().cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("chars")).alias("saved")),
        "trie-valued")

    # what a unit holds below its top, from small units to large
    sums = (F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    below = {0: stored(valued.filter("depth > 0").groupBy(F.col("parent").alias("name"), (F.col("depth") - 1).alias("u"))
                       .agg(*sums), "trie-below")}
    for k in range(1, height + 1):
        lower = below[k - 1].filter("u % 2 = 1").withColumn("u", F.expr("u div 2")).join(cuts[k], ["name", "u"]) \
            .select(F.col("root").alias("name"), "u", "leaves", "saved")
        below[k] = stored(below[k - 1].filter("u % 2 = 0").withColumn("u", F.expr("u div 2")).unionByName(lower)
                          .groupBy("name", "u").agg(*sums), "trie-below")

    # what hangs below the bottom nodes of a unit, from large units to small
    grafts = None
    for k in range(height, 0, -1):
        hung = below[k - 1].filter("u % 2 = 1").select("name", (F.col("u") - 1).alias("u"), "leaves", "saved")
        if grafts is not None:
            hung = hung.unionByName(grafts.join(named[k].select(F.col("conv").alias("name"), "u", "cut"), ["name", "u"])
                                    .select(F.col("cut").alias("name"), (2 * F.col("u")).alias("u"), "leaves", "saved"))
        hung = hung.groupBy("name", "u").agg(*sums)
        if grafts is not None:
            hung = hung.unionByName(grafts.withColumn("u", 2 * F.col("u") + 1))
        grafts = stored(hung, "trie-grafts")
    grafts = grafts.select("name", (F.col("u") + 1).alias("depth"), F.col("leaves").alias("more_leaves"),
                           F.col("saved").alias("more_saved")) \
        .unionByName(below[height].select("name", F.lit(0).cast("long").alias("depth"),
                                          F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved")))
    ended = ends[0]
    for more in ends[1:]:
        ended = ended.unionByName(more)
    return valued.join(grafts, ["name", "depth"], "left").join(stored(ended, "trie-ends"), ["name", "depth"], "left") \
        .select(F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"),
                F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
                F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
