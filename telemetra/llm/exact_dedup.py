"""Exact deduplication by distributed MSD radix partitioning (operator 9).

Texts are compared as byte strings after all ASCII white space is deleted.
The radix key of a text is its byte length followed by its bytes, so a text
is never a proper prefix of another one.  Round by round, all documents that
still share everything read so far are split by their next slice of bytes:

* one aggregation over (group, slice) counts each new group and finds the
  document that would stay; copies are combined on the map side, so a group
  of any size costs one row per task,
* documents whose group is a singleton, or whose text has ended, leave with
  their verdict; the others go to the next round with what is left of their
  bytes.

Slices grow by a constant factor, so the number of rounds is logarithmic in
the longest text, and every byte of a text is moved once.  No digest decides
equality.  The join that hands verdicts back to documents is a plain equi-join
with the (pre-aggregated) groups.  They are written first, so that the join
stands directly on two exchanges and Spark's adaptive skew handling can split
the partition of a large group of copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import BLANK, discard, stored, text_of


def normalised(text_col: str):
    """Text without ASCII white space."""
    return F.regexp_replace(text_of(text_col), f"[{BLANK}]+", "")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: str | None = None, first_slice: int = 64, growth: int = 4) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    ``carry`` names a column whose values are returned as ``carried``.

    Of equal texts, the row with the most code points in the original text
    stays, then the smallest id; a null id comes last.  Rows that repeat one
    id and text are separate rows, of which one stays.  Null and empty texts
    are equal; they form one group with texts of white space only.  An empty
    table gives an empty result; other columns of ``docs`` are not read.
    """
    norm = normalised(text_col)
    state = stored(docs.select(
        F.col(id_col).alias("id"), F.length(text_of(text_col)).alias("n_cp"),
        norm.cast("binary").alias("rest"), (F.col(carry) if carry else F.lit(None).cast("int")).alias("carried"),
    ).select(
        "*", F.monotonically_increasing_id().alias("row"), F.lit(0).cast("long").alias("grp"),
        F.octet_length("rest").alias("n_bytes"), F.sha2("rest", 256).alias("sha"),
    ), "msd-start")

    done = []
    at, width = 0, first_slice
    while True:
        state = state.withColumn("slice", F.expr(f"substring(rest, 1, {width})"))
        at += width
        groups = stored(state.groupBy("grp", "n_bytes", "slice").agg(
            F.count(F.lit(1)).alias("size"), F.min("row").alias("next"),
            F.min(F.struct((-F.col("n_cp")).alias("a"), F.col("id").isNull().alias("b"),
                           F.col("id").alias("c"), F.col("row").alias("d"))).alias("best"),
        ).filter("size > 1"), "msd-groups")
        ended = (F.col("size").isNull()) | (F.col("n_bytes") <= at)
        split = stored(state.join(groups.hint("merge"), ["grp", "n_bytes", "slice"], "left").select(
            "id", "row", "n_cp", "sha", "n_bytes", "carried", ended.alias("ended"),
            F.coalesce("size", F.lit(1)).cast("long").alias("size"),
            F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("best.c")).alias("keep_id"),
            (F.col("size").isNull() | (F.col("best.d") == F.col("row"))).alias("kept"),
            F.coalesce("next", "row").alias("grp"),
            F.when(~ended, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
        ), "msd-split")
        if at == first_slice:
            discard(state)
        done.append(split.filter("ended"))
        state = split.filter("not ended").drop("ended", "size", "keep_id", "kept")
        if state.isEmpty():
            break
        width *= growth
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(F.col("id").alias(id_col), "keep_id", F.col("size").alias("group_size"),
                      "kept", F.col("sha").alias("text_sha256"), *(["carried"] if carry else []))
