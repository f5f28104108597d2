"""Ordered per-asset sequences without one task per asset.

Row-frame windows (rolling statistics, lags, last-n rows) are defined per
asset in time order.  ``Window.partitionBy(asset)`` sends a whole asset to one
task, so a single hot asset holding a third of the table would stall the job.
This module numbers rows and cuts every asset into bounded blocks instead:

1. ``number_rows``: time is cut twice, into chunks (``chunk_seconds``) and
   into ``SLOTS`` slots of a chunk.  A window inside (asset, slot) gives the
   local position; the rows per slot are a two-level histogram of the asset:
   running sums over the slots of a chunk and over the chunks of an asset are
   its offsets, which one join adds back.  No window sees more than the rows
   of one slot, the slots of one chunk, or the chunks of one asset.  Result:
   ``_rn`` = 1-based position of the row inside its asset, ``_cnt`` = rows of
   the asset.
2. ``blocked``: rows are dealt into blocks of ``block_rows`` consecutive
   positions.  A row that lies within ``lookback`` rows of the next block is
   copied there as a halo row (``_halo``), likewise for ``lookahead``.  A
   window ``partitionBy(asset, _blk).orderBy(_rn)`` then sees every frame
   whole; halo rows are dropped afterwards.

``strategy="direct"`` uses plain ``partitionBy(asset)`` windows and serves as
the reference in tests.

Sliding aggregates (``sliding_aggs``) use the van Herk / Gil-Werman split:
the places of a block are cut into segments of ``w + 1`` rows, a frame
``[i-w, i]`` spans at most two segments, and is the combination of a suffix
aggregate (running in descending order) at ``i-w`` and a prefix aggregate
(running in ascending order) at ``i``.  Both are incremental, so the cost is
O(n) instead of the O(n * w) of a sliding ``rowsBetween`` frame, and every
partial sum covers at most ``w + 1`` rows, so rounding stays at the level of a
direct frame.  They are made block by block on Arrow columns: as windows they
took a sort of ever wider rows for every frame length and direction.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.profile import SensorProfile
from telemetra.session import cut_lineage, written

RN, CNT, BLK, HALO = "_rn", "_cnt", "_blk", "_halo"
BKEY = "_bkey"  # (asset, block) as one value that is never null itself: windows and joins share it
_CHUNK, _LRN, _OFF, _CC = "_chunk", "_lrn", "_off", "_cc"
#: Slots of a chunk: a slot is what one window partition numbers (a week's chunk has slots of ten minutes).
SLOTS = 1024


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null equals null; the keys are kept once.

    Rows without an asset or a time are rows like any others.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"_right_{k}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def _slot_expr(profile: SensorProfile) -> Column:
    """Number of the slot of a row's time; null times have none."""
    micros = F.unix_micros(F.col(profile.ts).cast("timestamp"))
    return F.floor(micros / F.lit(max(profile.chunk_seconds * 1_000_000 // SLOTS, 1))).cast("long")


def number_rows(df: DataFrame, profile: SensorProfile, strategy: str = "chunked",
                with_count: bool = True) -> DataFrame:
    """Add ``_rn`` (1-based position per asset in time order) and ``_cnt``."""
    a = profile.asset
    order = profile.order_exprs()
    if strategy == "direct":
        w = Window.partitionBy(a).orderBy(*order)
        out = df.withColumn(RN, F.row_number().over(w).cast("long"))
        if with_count:
            out = out.withColumn(CNT, F.count(F.lit(1)).over(Window.partitionBy(a)))
        return out

    # a struct of null fields is not null, so null keys group and join like others
    # and the join stands on the window's partitioning
    slotted = df.withColumn(_CHUNK, F.struct(F.col(a).alias("a"), _slot_expr(profile).alias("s")))
    local = slotted.withColumn(_LRN, F.row_number().over(Window.partitionBy(_CHUNK).orderBy(*order)))
    joined = local.join(_offsets(slotted.groupBy(_CHUNK).agg(F.count(F.lit(1)).alias(_CC)), with_count), _CHUNK)
    return joined.withColumn(RN, (F.col(_OFF) + F.col(_LRN)).cast("long")).drop(
        _CHUNK, _LRN, _OFF)


def _offsets(counts: DataFrame, with_count: bool) -> DataFrame:
    """Rows of the asset before each slot, from the rows per (asset, slot); with ``_cnt`` the asset's rows."""
    earlier = (Window.unboundedPreceding, -1)
    span = F.struct(F.col(f"{_CHUNK}.a").alias("a"), F.floor(F.col(f"{_CHUNK}.s") / SLOTS).alias("c"))
    slots = counts.withColumn("_span", span)
    inside = Window.partitionBy("_span").orderBy(f"{_CHUNK}.s")
    slots = slots.select(_CHUNK, "_span", F.coalesce(F.sum(_CC).over(inside.rowsBetween(*earlier)), F.lit(0)).alias("_in"))
    spans = counts.groupBy(span.alias("_span")).agg(F.sum(_CC).alias(_CC))
    per_asset = Window.partitionBy("_span.a")
    spans = spans.select(
        "_span", F.coalesce(F.sum(_CC).over(per_asset.orderBy("_span.c").rowsBetween(*earlier)), F.lit(0)).alias("_before"),
        *([F.sum(_CC).over(per_asset).alias(CNT)] if with_count else []))
    return slots.join(spans, "_span").select(
        _CHUNK, (F.col("_in") + F.col("_before")).alias(_OFF), *([CNT] if with_count else []))


def ordered_positions(df: DataFrame, order: list[str], group: str | None = None) -> DataFrame:
    """Add ``_rn`` (1-based position) and ``_cnt`` over the whole table, or inside ``group``.

    The table is sorted by ranges of (group, order), of any types, nulls
    first, and written once (a checkpoint); every partition's rows have
    consecutive places, and the rows before a partition are a running sum over
    the partitions (of a group).  No key is ordered in one task, except rows
    that are equal in all of them.
    """
    keys = [group] if group else []
    placed = cut_lineage(df.orderBy(*[F.col(c).asc_nulls_first() for c in [*keys, *order]])
                         .withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}))
    runs = placed.groupBy(*keys, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*keys, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_skip"),
                       F.sum("_n").over(Window.partitionBy(*keys)).alias(CNT))
    return null_safe_join(placed, runs, [*keys, "_part"]) \
        .withColumn(RN, F.col("_place") - F.col("_first") + F.col("_skip") + 1) \
        .drop("_part", "_place", "_first", "_skip")


def renumber(df: DataFrame, profile: SensorProfile, strategy: str = "chunked", with_count: bool = True) -> DataFrame:
    """Recompute ``_rn``/``_cnt`` after rows were filtered out; ``_cnt`` only with ``with_count``.

    Input must carry ``_rn`` and ``_blk`` (no halo rows).  The local position
    inside each block plus the running count of earlier blocks gives the new
    position; only a per-block count table is aggregated.  The rows are
    written once: counting them must not run all that led to them again.
    Without ``_cnt`` they are not shuffled for it: only blocks after an
    asset's first have rows before them (one block in ``block_rows`` rows at
    most), and these few are broadcast.
    """
    a = profile.asset
    if strategy == "direct":
        w = Window.partitionBy(a)
        out = df.drop(CNT).withColumn(RN, F.row_number().over(w.orderBy(RN)).cast("long"))
        return (out.withColumn(CNT, F.count(F.lit(1)).over(w)) if with_count else out).drop(BLK, BKEY)
    local = written(df.withColumn(_LRN, F.row_number().over(Window.partitionBy(BKEY).orderBy(RN))).drop(RN, CNT),
                    "numbered")
    counts = local.groupBy(BKEY).agg(F.count(F.lit(1)).alias(_CC))
    per_asset = Window.partitionBy(f"{BKEY}.a").orderBy(f"{BKEY}.b")
    offsets = counts.select(
        BKEY,
        F.coalesce(F.sum(_CC).over(per_asset.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(_OFF),
        *([F.sum(_CC).over(Window.partitionBy(f"{BKEY}.a")).alias(CNT)] if with_count else []),
    )
    if with_count:
        out = local.join(offsets, BKEY)
    else:
        out = local.join(F.broadcast(offsets.filter(f"{BKEY}.b > 0")), BKEY, "left").fillna(0, [_OFF])
    return out.withColumn(RN, (F.col(_OFF) + F.col(_LRN)).cast("long")).drop(
        _LRN, _OFF, BLK, BKEY)


def blocked(df: DataFrame, profile: SensorProfile, lookback: int, lookahead: int = 0,
            strategy: str = "chunked", block_rows: int | None = None) -> DataFrame:
    """Deal numbered rows into blocks with halo copies (see module doc).

    ``direct`` keeps one block per asset (the reference form of tests);
    ``chunked`` blocks are correct for any numbering and, for assets smaller
    than a block, add no rows and no shuffle beyond the asset partitioning.
    """
    if strategy == "direct":
        return _keyed(df.withColumn(BLK, F.lit(0).cast("long")).withColumn(HALO, F.lit(False)), profile)
    size = max(int(block_rows or profile.block_rows), lookback, lookahead, 1)
    pos = (F.col(RN) - 1) % size
    blk = F.floor((F.col(RN) - 1) / size).cast("long")
    targets = [F.struct(blk.alias("b"), F.lit(False).alias("h"))]
    if lookback > 0:
        targets.append(F.when(pos >= size - lookback,
                              F.struct((blk + 1).alias("b"), F.lit(True).alias("h"))))
    if lookahead > 0:
        targets.append(F.when((pos < lookahead) & (blk > 0),
                              F.struct((blk - 1).alias("b"), F.lit(True).alias("h"))))
    exploded = df.withColumn("_t", F.explode(F.filter(F.array(*targets), lambda t: t.isNotNull())))
    return _keyed(exploded.withColumn(BLK, F.col("_t.b")).withColumn(HALO, F.col("_t.h")).drop("_t"), profile)


def _keyed(frame: DataFrame, profile: SensorProfile) -> DataFrame:
    return frame.withColumn(BKEY, F.struct(F.col(profile.asset).alias("a"), F.col(BLK).alias("b")))


def ordered_window(profile: SensorProfile) -> Window:
    """Window over a blocked frame, ordered by asset position."""
    return Window.partitionBy(BKEY).orderBy(RN)


def sequence_frame(df: DataFrame, profile: SensorProfile, lookback: int, lookahead: int = 0,
                   strategy: str = "chunked", block_rows: int | None = None) -> DataFrame:
    """number_rows + blocked in one call."""
    numbered = number_rows(df, profile, strategy=strategy)
    return blocked(numbered, profile, lookback, lookahead, strategy, block_rows)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(HALO)


def _over_frames(values: np.ndarray, w: int, step: np.ufunc, neutral) -> np.ndarray:
    """``step`` over the last ``w + 1`` values of each place; one row per column."""
    k, n = values.shape
    segments = -(-n // (w + 1))
    cells = np.full((k, segments * (w + 1)), neutral, dtype=values.dtype)
    cells[:, :n] = values
    cells = cells.reshape(k, segments, w + 1)
    upto = step.accumulate(cells, axis=2).reshape(k, -1)[:, :n]
    if n > w:
        after = step.accumulate(cells[:, :, ::-1], axis=2)[:, :, ::-1].reshape(k, -1)[:, :n - w]
        # a frame of one whole segment is the running value at its end, others begin in the segment before
        two = np.arange(n - w) % (w + 1) != 0
        upto[:, w:][:, two] = step(after[:, two], upto[:, w:][:, two])
    return upto


def _block_frames(columns: list, w: int, kinds: set[str]) -> dict[str, list]:
    """``kinds`` of all frames of a block, per column; null where a frame has no value (std: two values)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    given = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
    # nulls are zeros here, and masked below
    x = np.stack([pc.fill_null(c.cast(pa.float64(), safe=False), 0.0).to_numpy() for c in columns])
    n = _over_frames(given.astype(np.int64), w, np.add, 0)
    out: dict[str, list] = {}

    def keep(kind: str, values: np.ndarray, least: int) -> None:
        out[kind] = [pa.array(v, mask=m) for v, m in zip(values, n < least)]

    with np.errstate(all="ignore"):
        if kinds & {"min", "max", "std"}:
            # NaN is above all others
            lo = _over_frames(np.where(given, x, np.nan), w, np.fmin, np.nan)
            hi = _over_frames(np.where(given, x, -np.inf), w, np.maximum, -np.inf)
            keep("min", lo, 1)
            keep("max", hi, 1)
        if kinds & {"mean", "std"}:
            # a shift by the block's mean keeps sums of squares well conditioned
            known = given & np.isfinite(x)
            shift = (np.where(known, x, 0.0).sum(axis=1) / np.maximum(known.sum(axis=1), 1))[:, None]
            moved = np.where(given, x - shift, 0.0)
            s = _over_frames(moved, w, np.add, 0.0)
            keep("mean", shift + s / n, 1)
        if "std" in kinds:
            q = _over_frames(moved * moved, w, np.add, 0.0)
            keep("std", np.where(lo == hi, 0.0, np.sqrt(np.maximum((q - s * s / n) / (n - 1), 0.0))), 2)
    if kinds & {"min", "max"}:
        for i, c in enumerate(columns):
            if pa.types.is_integer(c.type):  # in their own numbers: doubles would round large ones
                whole = pc.fill_null(c.cast(pa.int64()), 0).to_numpy()[None, :]
                ends = np.iinfo(np.int64)
                for kind, step, neutral in (("min", np.minimum, ends.max), ("max", np.maximum, ends.min)):
                    over = _over_frames(np.where(given[i:i + 1], whole, neutral), w, step, neutral)
                    out[kind][i] = pa.array(over[0], mask=n[i] < 1)
    return out


def sliding_aggs(frame: DataFrame, profile: SensorProfile, specs: list[tuple[str, str, int, str]]
                 ) -> DataFrame:
    """Add sliding-frame aggregates over ``rowsBetween(-w, 0)`` in O(n).

    ``specs``: (output_name, input_column, w, kind) with kind in
    ``mean std min max``.  ``frame`` must come from :func:`sequence_frame`
    (or :func:`blocked`) with ``lookback >= w``.  Results equal
    ``avg/stddev_samp/min/max`` over the direct frame.  Values are shifted by
    the mean of their block before squares are summed; a frame whose values are all equal has
    standard deviation exactly 0, as its least and greatest value agree.

    Plan shape: one sort of the frame's own columns by block, whatever the
    number of aggregates; all of them are made block by block, so a task
    holds the results of one block at a time.
    """
    import pyarrow as pa

    by_w: dict[int, list[tuple[str, str, str]]] = {}
    for name, src, w, kind in specs:
        if kind not in ("mean", "std", "min", "max"):
            raise ValueError(f"unknown aggregate {kind!r}")
        by_w.setdefault(int(w), []).append((name, src, kind))
    types = {name: frame.schema[src].dataType if kind in ("min", "max") else T.DoubleType()
             for name, src, _, kind in specs}
    made = [name for items in by_w.values() for name, _, _ in items]
    schema = T.StructType([*frame.schema.fields, *[T.StructField(name, types[name]) for name in made]])

    def with_frames(table: pa.Table) -> pa.Table:
        table = table.sort_by(RN).combine_chunks()
        for w, items in by_w.items():
            srcs = sorted({src for _, src, _ in items})
            found = _block_frames([table.column(c).combine_chunks() for c in srcs], w, {k for _, _, k in items})
            for name, src, kind in items:
                values = found[kind][srcs.index(src)]
                if kind in ("min", "max"):
                    values = values.cast(table.column(src).type)
                table = table.append_column(name, values)
        return table

    return frame.groupBy(BKEY).applyInArrow(with_frames, schema)
