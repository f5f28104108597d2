"""Cleaning, projections and predicates."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.operators import sequence as seq
from telemetra.profile import SensorProfile


def nan_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """NaN -> null for the given double columns (Spark orders NaN above all)."""
    cols = list(cols)
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def split_valid(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Tag every row with the list of violated bounds.

    Adds ``reasons`` (``;``-joined, empty when valid) and ``is_valid``.  A
    missing value violates nothing (the declared model allows nulls), as does
    a value on a bound.  Use ``valid_rows``/``rejected_rows`` to split.
    """
    checks = [
        F.when(~F.col(c).between(lo, hi), F.lit(f"{c} out of [{lo}, {hi}]"))
        for c, (lo, hi) in bounds.items()
    ]
    reasons = F.array_compact(F.array(*checks))
    return df.withColumn("reasons", F.array_join(reasons, ";")).withColumn(
        "is_valid", F.size(reasons) == 0)


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("is_valid")).drop("reasons", "is_valid")


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(~F.col("is_valid")).drop("is_valid")


def dedup_readings(df: DataFrame, profile: SensorProfile,
                   keys: Iterable[str] | None = None) -> DataFrame:
    """One row per (asset, ts); the survivor is the first by tiebreak.

    Expressed as an aggregation (``min`` of a struct led by the tiebreak
    columns) so map-side partial aggregation collapses copies before the
    shuffle: a group of copies holding a third of the table costs one row
    per map task, not one task for the whole group.
    """
    keys = list(keys or [profile.asset, profile.ts])
    rest = [c for c in df.columns if c not in keys]
    lead = [c for c in profile.tiebreak if c in rest]
    tail = [c for c in rest if c not in lead]
    packed = F.min(F.struct(*[F.col(c) for c in lead + tail])).alias("_row")
    return df.groupBy(*keys).agg(packed).select(
        *keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def null_out_of_range(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Values outside the inclusive limits become null (never dropped)."""
    return df.withColumns({
        c: F.when(F.col(c).between(lo, hi), F.col(c))
        for c, (lo, hi) in limits.items() if c in df.columns
    })


def fill_previous(df: DataFrame, profile: SensorProfile, sensors: Iterable[str] | None = None,
                  mode: str = "one_step", strategy: str = "chunked",
                  keep_sequence: bool = False) -> DataFrame:
    """C4: fill nulls from earlier rows of the same asset.

    ``one_step`` (the source behaviour): only the immediately preceding row
    is consulted, so a second consecutive null stays null.  ``full``: last
    non-null value (classic forward fill), carried across blocks through a
    per-block table of last values.
    """
    sensors = list(sensors or profile.sensors)
    frame = seq.sequence_frame(df, profile, lookback=1 if mode == "one_step" else 0,
                               strategy=strategy)
    w = seq.ordered_window(profile)
    if mode == "one_step":
        out = frame.withColumns({
            c: F.coalesce(F.col(c), F.lag(F.col(c), 1).over(w)) for c in sensors})
        out = seq.drop_halo(out)
    elif mode == "full":
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        out = frame.withColumns({
            c: F.last(F.col(c), ignorenulls=True).over(run) for c in sensors})
        out = seq.drop_halo(out)
        # value carried into each block from earlier blocks
        last_in_block = frame.groupBy(seq.BKEY).agg(*[
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq.RN))).alias(f"_lb_{c}")
            for c in sensors])
        carry_w = Window.partitionBy(f"{seq.BKEY}.a").orderBy(f"{seq.BKEY}.b") \
            .rowsBetween(Window.unboundedPreceding, -1)
        carry = last_in_block.select(seq.BKEY, *[
            F.last(F.col(f"_lb_{c}"), ignorenulls=True).over(carry_w).alias(f"_cy_{c}")
            for c in sensors])
        out = out.join(carry, seq.BKEY, "left").withColumns({
            c: F.coalesce(F.col(c), F.col(f"_cy_{c}")) for c in sensors}).drop(
            *[f"_cy_{c}" for c in sensors])
    else:
        raise ValueError(f"unknown fill mode {mode!r}")
    if keep_sequence:
        return out
    return out.drop(seq.RN, seq.CNT, seq.BLK, seq.BKEY)


def drop_incomplete(df: DataFrame, sensors: Iterable[str]) -> DataFrame:
    """Drop rows where any sensor is null."""
    return df.dropna(subset=list(sensors))


def clean_readings(df: DataFrame, profile: SensorProfile, mode: str = "one_step",
                   strategy: str = "chunked", keep_sequence: bool = False,
                   carry: Iterable[str] | None = None, with_count: bool = True) -> DataFrame:
    """C2-C5 chain: dedup, out-of-range to null, fill, drop incomplete rows.

    With ``keep_sequence`` the result keeps ``_rn``/``_cnt`` renumbered over
    the surviving rows, so a following windowed stage need not number again;
    without ``with_count`` it has ``_rn`` only, which spares a shuffle of a
    table with many assets.
    The result has the columns of ``df``; with ``carry`` given only those of
    it beside asset, time and sensors, which spares the later shuffles.
    """
    sensors = list(profile.sensors)
    kept = None if carry is None else [profile.asset, profile.ts, *sensors, *carry]
    if strategy == "direct":
        x = _clean_direct(df, profile, sensors, mode, keep_sequence)
        if keep_sequence and not with_count:
            x = x.drop(seq.CNT)
        return x if kept is None else x.select(*kept, *[c for c in (seq.RN, seq.CNT) if c in x.columns])
    x = nan_to_null(df, sensors)
    x = dedup_readings(x, profile)
    if kept is not None:
        x = x.select(*kept)
    # one row per asset and time is left: the time alone orders them
    profile = profile.with_(tiebreak=())
    x = null_out_of_range(x, profile.limits)
    x = fill_previous(x, profile, sensors, mode=mode, strategy=strategy, keep_sequence=True)
    x = drop_incomplete(x, sensors)
    if keep_sequence:
        return seq.renumber(x, profile, strategy=strategy, with_count=with_count)
    return x.drop(seq.RN, seq.CNT, seq.BLK, seq.BKEY)


def _clean_direct(df: DataFrame, profile: SensorProfile, sensors: list[str], mode: str,
                  keep_sequence: bool) -> DataFrame:
    """The reference form of tests: one shuffle by asset, one time-ordered sort.

    Copies of (asset, ts) are adjacent in (ts, tiebreak) order, so the first
    of each run survives (the same survivor as ``dedup_readings``); the fill
    and the numbering reuse the same partitioning and order.
    """
    a, ts = profile.asset, profile.ts
    w = Window.partitionBy(a).orderBy(*profile.order_exprs())
    x = nan_to_null(df, sensors)
    first = F.row_number().over(w) == 1
    x = x.withColumn("_dup", ~first & F.col(ts).eqNullSafe(F.lag(ts, 1).over(w)))
    x = x.filter(~F.col("_dup")).drop("_dup")
    x = null_out_of_range(x, profile.limits)
    if mode == "one_step":
        x = x.withColumns({c: F.coalesce(F.col(c), F.lag(c, 1).over(w)) for c in sensors})
    elif mode == "full":
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        x = x.withColumns({c: F.last(F.col(c), ignorenulls=True).over(run) for c in sensors})
    else:
        raise ValueError(f"unknown fill mode {mode!r}")
    x = drop_incomplete(x, sensors)
    if keep_sequence:
        x = x.withColumn(seq.RN, F.row_number().over(w).cast("long")) \
            .withColumn(seq.CNT, F.count(F.lit(1)).over(Window.partitionBy(a)))
    return x


def with_physics(df: DataFrame, discharge: str = "discharge_pressure_bar",
                 inlet: str = "inlet_pressure_bar", fuel: str = "fuel_flow_kg_s",
                 load: str = "turbine_load_mw") -> DataFrame:
    """Pressure ratio, heat rate and clipped efficiency."""
    d, i, f, l = (F.col(discharge), F.col(inlet), F.col(fuel), F.col(load))
    eff = F.try_divide(l, f * 45 + 0.01) * 100 / 0.38
    return df.withColumns({
        "pressure_ratio": F.try_divide(d, i),
        "heat_rate": F.try_divide(f * 3600 * 45, l + 0.01),
        # least and greatest skip nulls; a missing reading stays missing
        "efficiency_pct": F.when(eff.isNotNull(), F.least(F.greatest(eff, F.lit(50.0)), F.lit(110.0))),
    })


LINEAGE_COLUMNS = ("ingestion_timestamp", "source_file", "data_quality_flag", "year",
                   "month", "day", "processing_timestamp")


def training_projection(df: DataFrame, profile: SensorProfile,
                        exclude: Iterable[str] = LINEAGE_COLUMNS,
                        drop_labels: Iterable[str] = ()) -> DataFrame:
    """Key columns first, then every feature not excluded.

    Labels stay among the features unless listed in ``drop_labels`` (the
    source keeps them, which leaks the label into training).
    """
    skip = {profile.ts, profile.asset, *exclude, *drop_labels}
    feats = [c for c in df.columns if c not in skip]
    return df.select(profile.ts, profile.asset, *feats)


def with_fault_label(df: DataFrame, fault_expr: str = "fault_type != 'normal'",
                     name: str = "is_faulty") -> DataFrame:
    """1 when the fault predicate is true; null or false give 0."""
    return df.withColumn(name, F.when(F.expr(fault_expr), 1).otherwise(0))


def impute(df: DataFrame, cols: Iterable[str], strategy: str = "median",
           medians: DataFrame | None = None) -> DataFrame:
    """Fill missing values.

    ``median``: exact training medians (``medians`` = one row with a column
    per feature, e.g. from :func:`column_medians`; computed from ``df`` when
    omitted), then +-inf -> 0.  ``zero``: null and +-inf -> 0.
    """
    cols = list(cols)

    def finite(c: Column) -> Column:
        return F.when(F.abs(c) == F.lit(float("inf")), F.lit(0.0)).otherwise(c)

    if strategy == "zero":
        return df.withColumns({c: F.coalesce(finite(F.col(c)), F.lit(0.0)) for c in cols})
    if strategy != "median":
        raise ValueError(strategy)
    if medians is None:
        medians = column_medians(df, cols)
    # one value per feature: a fixed-size row, read back as literals
    row = medians.select(*cols).first()
    filled = df.withColumns({
        c: F.coalesce(F.nanvl(F.col(c), F.lit(None).cast("double")),
                      F.lit(row[c]).cast("double"))
        for c in cols})
    return filled.withColumns({c: F.coalesce(finite(F.col(c)), F.lit(0.0)) for c in cols})


def column_medians(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One-row DataFrame of exact medians (infinite values excluded)."""
    from telemetra.operators.stats import exact_quantiles, unpivot

    cols = list(cols)
    longf = unpivot(df, cols, id_cols=[], var="feature", val="value")
    longf = longf.filter(F.abs(F.col("value")) != F.lit(float("inf")))
    q = exact_quantiles(longf, ["feature"], "value", [0.5], few_groups=True)
    return q.groupBy().agg(*[
        F.max(F.when(F.col("feature") == c, F.col("q"))).alias(c) for c in cols])


def only_normal(df: DataFrame, profile: SensorProfile) -> DataFrame:
    """C11: rows whose fault predicate is not true."""
    return df.filter(profile.fault_col() == 0)


def only_faulty(df: DataFrame, profile: SensorProfile) -> DataFrame:
    return df.filter(profile.fault_col() == 1)


def for_assets(df: DataFrame, profile: SensorProfile, ids: Iterable) -> DataFrame:
    """C11: keep the listed assets (pushed down to the scan)."""
    return df.filter(F.col(profile.asset).isin(list(ids)))


def union_sources(dfs: Iterable[DataFrame]) -> DataFrame:
    """Vertical union by name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(dfs))
