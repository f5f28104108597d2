"""Greedy cooldown as a composed fold.

An event fires when its time has reached the end of the cooldown that the last
fired event of its key began.  What a run of events does to that end is a step
function: for every end at which the run can be entered, the end at which it
is left.  Two neighbouring runs' functions compose to the function of both, so
the fold needs no order of work beyond that:

1. the places of a key are numbered and cut into segments of ``SEGMENT`` rows;
   each (key, segment) gives its function, as a table,
2. ``GROUP`` segments are composed in a task, and the groups' functions are
   followed along a key; then each group follows its segments, so that every
   segment knows the end it is entered with,
3. each (key, segment) marks the places that fire.

A key of one segment is entered free and goes to the last step at once.

A table holds one row per place within one cooldown of the segment's first
place at most (neighbours of one exit are one row), and a task reads one
segment, or the tables of one group.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.operators.sequence import CNT, RN, number_rows
from telemetra.profile import SensorProfile
from telemetra.session import cut_lineage

#: Places of a segment, segments of a group.
SEGMENT, GROUP = 100_000, 512
#: The end that a key is entered with: any event may fire.
FREE = np.iinfo(np.int64).min

_LONGS = T.ArrayType(T.LongType())


def _schema(kind: T.DataType, **columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("_k", kind), T.StructField("seg", T.LongType()),
                         *(T.StructField(c, t) for c, t in columns.items())])


def successors(times: np.ndarray, cooldown: int) -> np.ndarray:
    """For each place the first one that may fire after it; their number where there is none."""
    return np.searchsorted(times, times + cooldown, "left")


def step_table(times: np.ndarray, cooldown: int) -> tuple[np.ndarray, np.ndarray]:
    """The function of a segment: an end up to ``upto[i]`` (and beyond the one before) becomes ``ends[i]``.

    An end beyond the last ``upto`` passes unchanged: nothing fires.
    """
    after = successors(times, cooldown)
    last = np.where(after < len(times), after, np.arange(len(times)))
    while not np.array_equal(further := last[last], last):  # the last place that fires in the chain of each
        last = further
    inside = min(int(after[0]) + 1, len(times))  # entered within one cooldown of the first place
    return merged(times[:inside], times[last[:inside]] + cooldown)


def merged(upto: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring steps with one exit as one step."""
    keep = np.append(ends[1:] != ends[:-1], True) if len(ends) else np.zeros(0, bool)
    return upto[keep], ends[keep]


def followed(upto: np.ndarray, ends: np.ndarray, entered: np.ndarray) -> np.ndarray:
    """The ends that a segment is left with."""
    at = np.searchsorted(upto, entered, "left")
    return np.where(at < len(upto), np.append(ends, 0)[np.minimum(at, len(upto))], entered)


def composed(a: tuple, b: tuple, first: int, cooldown: int) -> tuple[np.ndarray, np.ndarray]:
    """The function of two neighbouring runs; ``first`` is the time of the first place of both."""
    passes = b[0] > a[0][-1]  # ends that the first run passes on unchanged
    upto = np.concatenate([a[0], b[0][passes]])
    ends = np.concatenate([followed(*b, a[1]), b[1][passes]])
    reach = int(np.searchsorted(upto, first + cooldown, "left")) + 1
    return merged(upto[:reach], ends[:reach])


def fired_places(times: np.ndarray, cooldown: int, entered: int) -> list[int]:
    """The places of a segment that fire."""
    after, out = successors(times, cooldown), []
    at = int(np.searchsorted(times, entered, "left"))
    while at < len(times):
        out.append(at)
        at = int(after[at])
    return out


def _key(table):
    return table.column("_k").slice(0, 1).combine_chunks()


def _tables(table):
    """Tables of a group's segments in order: (segment, upto, ends, first, cooldown)."""
    t = table.sort_by("seg")
    for seg, upto, ends, first, cooldown in zip(*(t.column(c) for c in ("seg", "upto", "ends", "first", "cooldown"))):
        yield (seg.as_py(), upto.values.to_numpy(), ends.values.to_numpy(), first.as_py(), cooldown.as_py())


def fired(places: DataFrame, key: str, time: str, cooldown: str) -> DataFrame:
    """The rows of ``places`` that fire: ``places`` is one row per (``key``, ``time``).

    ``key`` is a struct (null fields are values), ``time`` and ``cooldown``
    are microseconds, the cooldown is positive and one per key.
    """
    import pyarrow as pa

    named = places.withColumnsRenamed({key: "_k"})
    profile = SensorProfile(asset="_k", ts="_at", sensors=())
    numbered = number_rows(named.withColumn("_at", F.timestamp_micros(F.col(time))), profile)
    cut = cut_lineage(numbered.withColumn("seg", F.floor((F.col(RN) - 1) / SEGMENT).cast("long")).drop(RN, "_at"))
    kind = cut.schema["_k"].dataType
    steps = _schema(kind, upto=_LONGS, ends=_LONGS, first=T.LongType(), cooldown=T.LongType())
    entries = _schema(kind, entered=T.LongType())

    def function_of(table: pa.Table) -> pa.Table:
        t = np.sort(table.column(time).to_numpy())
        wait = table.column(cooldown)[0].as_py()
        upto, ends = step_table(t, wait)
        return pa.table({"_k": _key(table), "seg": table.column("seg").slice(0, 1).combine_chunks(),
                         "upto": pa.array([upto.tolist()], pa.list_(pa.int64())),
                         "ends": pa.array([ends.tolist()], pa.list_(pa.int64())),
                         "first": pa.array([int(t[0])]), "cooldown": pa.array([wait])})

    whole, many = cut.filter(F.col(CNT) <= SEGMENT).drop(CNT), cut.filter(F.col(CNT) > SEGMENT).drop(CNT)

    def marked(table: pa.Table, entered: int) -> pa.Table:
        t = table.sort_by(time)
        return t.take(pa.array(fired_places(t.column(time).to_numpy(), t.column(cooldown)[0].as_py(), entered), pa.int64()))

    tables = many.select("_k", "seg", time, cooldown).groupBy("_k", "seg") \
        .applyInArrow(function_of, steps)

    def compose(table: pa.Table) -> pa.Table:
        parts = list(_tables(table))
        _, upto, ends, first, wait = parts[0]
        for _, more, left, _, _ in parts[1:]:
            upto, ends = composed((upto, ends), (more, left), first, wait)
        return pa.table({"_k": _key(table), "seg": pa.array([parts[0][0] // GROUP]),
                         "upto": pa.array([upto.tolist()], pa.list_(pa.int64())),
                         "ends": pa.array([ends.tolist()], pa.list_(pa.int64())),
                         "first": pa.array([first]), "cooldown": pa.array([wait])})

    def follow(table: pa.Table, entered: int) -> pa.Table:
        """The end that each segment of the table is entered with."""
        segs, ends = [], []
        for seg, upto, left, _, _ in _tables(table):
            segs.append(seg)
            ends.append(entered)
            entered = int(followed(upto, left, np.array([entered], np.int64))[0])
        return pa.table({"_k": pa.chunked_array([pa.concat_arrays([_key(table)] * len(segs))]),
                         "seg": pa.array(segs, pa.int64()), "entered": pa.array(ends, pa.int64())})

    by_group = F.floor(F.col("seg") / GROUP).cast("long")
    groups = tables.groupBy("_k", by_group.alias("grp")).applyInArrow(lambda k, t: compose(t), steps) \
        .groupBy("_k").applyInArrow(lambda t: follow(t, FREE), entries)
    segments = tables.withColumn("grp", by_group).groupBy("_k", "grp").cogroup(
        groups.withColumnRenamed("seg", "grp").groupBy("_k", "grp")).applyInArrow(
        lambda t, e: follow(t, e.column("entered")[0].as_py()), entries)

    out = many.groupBy("_k", "seg").cogroup(segments.groupBy("_k", "seg")).applyInArrow(
        lambda t, e: marked(t, e.column("entered")[0].as_py()), many.schema)
    alone = whole.groupBy("_k").applyInArrow(lambda t: marked(t, FREE), whole.schema)
    return alone.unionByName(out).drop("seg").withColumnsRenamed({"_k": key})
