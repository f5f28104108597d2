"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of all nodes of ``edges`` (``a, b``).

    Every round is two aggregations over the edges (smallest neighbour of a
    node) and joins back; the number of rounds is logarithmic in practice and
    edges never grow beyond one per node and neighbour.  Nothing is collected.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "cc-edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "cc-least")
        large = stored(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .filter("a <> b").distinct(), "cc-large")
        lower = stored(large.groupBy("a").agg(F.min("b").alias("m")), "cc-lower")
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .union(lower.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        after = stored(small, "cc-edges")
        for used in (now, least, large, lower):
            discard(used)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .union(now.select("b", "b").distinct())
