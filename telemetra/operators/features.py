"""Time-series features per asset (W1-W4, W6-W8, S1) on blocked sequences.

Every operator accepts either plain readings (it numbers them) or a frame
that already carries ``_rn``/``_cnt`` from :func:`clean.clean_readings`
with ``keep_sequence=True``.  Frames are ``rowsBetween(-w, 0)``: w + 1 rows
including the current one, as in the source.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.functions.scoring import cross_sensor_columns
from telemetra.operators import sequence as seq
from telemetra.profile import SensorProfile


def _framed(df: DataFrame, profile: SensorProfile, lookback: int, lookahead: int,
            strategy: str, block_rows: int | None) -> DataFrame:
    if seq.RN not in df.columns:
        df = seq.number_rows(df, profile, strategy=strategy)
    return seq.blocked(df, profile, lookback, lookahead, strategy=strategy, block_rows=block_rows)


def _carried(frame: DataFrame, keep_sequence: bool) -> DataFrame:
    """The columns that go through the sliding aggregates."""
    return frame if keep_sequence else frame.drop(seq.CNT)


def _finish(df: DataFrame, keep_sequence: bool) -> DataFrame:
    out = seq.drop_halo(df).drop(seq.BLK, seq.BKEY)
    return out if keep_sequence else out.drop(seq.RN, seq.CNT)


def rolling_stats(df: DataFrame, profile: SensorProfile, sensors: Sequence[str] | None = None,
                  windows: Sequence[int] = (12, 144), stats: Sequence[str] = (
                      "mean", "std", "min", "max"), strategy: str = "chunked",
                  block_rows: int | None = None, keep_sequence: bool = False) -> DataFrame:
    """``<sensor>_rolling_<stat>_<w>`` over ``rowsBetween(-w, 0)``."""
    sensors = list(sensors or profile.sensors)
    frame = _framed(df, profile, max(windows), 0, strategy, block_rows)
    specs = [(f"{s}_rolling_{st}_{w}", s, w, st) for w in windows for s in sensors for st in stats]
    out = seq.sliding_aggs(_carried(frame, keep_sequence), profile, specs)
    return _finish(out, keep_sequence)


def rate_of_change(df: DataFrame, profile: SensorProfile, sensors: Sequence[str] | None = None,
                   strategy: str = "chunked", block_rows: int | None = None,
                   keep_sequence: bool = False) -> DataFrame:
    """X - lag(x) and its difference, x - 2 lag(x) + lag(x, 2)."""
    sensors = list(sensors or profile.sensors)
    frame = _framed(df, profile, 2, 0, strategy, block_rows)
    out = frame.withColumns(_rate_cols(sensors, seq.ordered_window(profile)))
    return _finish(out, keep_sequence)


def _rate_cols(sensors: Iterable[str], w: Window) -> dict[str, Column]:
    cols: dict[str, Column] = {}
    for s in sensors:
        x, l1, l2 = F.col(s), F.lag(s, 1).over(w), F.lag(s, 2).over(w)
        cols[f"{s}_rate_of_change"] = x - l1
        cols[f"{s}_acceleration"] = (x - l1) - (l1 - l2)
    return cols


def zscore_flags(df: DataFrame, profile: SensorProfile, sensors: Sequence[str] | None = None,
                 lookback: int = 288, sigma: float = 3.0, min_sensors: int = 2,
                 strategy: str = "chunked", block_rows: int | None = None,
                 keep_sequence: bool = False) -> DataFrame:
    """Rolling z-score per sensor, flags, anomaly_score, is_anomaly.

    z = (x - mean) / std over ``rowsBetween(-lookback, 0)`` when std > 0,
    else 0.0; flag = |z| > sigma; anomaly_score = number of flags;
    is_anomaly = anomaly_score >= min_sensors.
    """
    sensors = list(sensors or profile.sensors)
    frame = _framed(df, profile, lookback, 0, strategy, block_rows)
    out = seq.sliding_aggs(_carried(frame, keep_sequence), profile, _zscore_specs(sensors, lookback))
    out = _with_zscores(out, sensors, sigma, min_sensors)
    return _finish(out, keep_sequence)


def _zscore_specs(sensors: Sequence[str], lookback: int) -> list[tuple[str, str, int, str]]:
    return [x for s in sensors for x in ((f"_m_{s}", s, lookback, "mean"), (f"_sd_{s}", s, lookback, "std"))]


def _with_zscores(out: DataFrame, sensors: Sequence[str], sigma: float, min_sensors: int) -> DataFrame:
    """Z-scores and flags from the columns of :func:`_zscore_specs`."""
    zcols: dict[str, Column] = {}
    for s in sensors:
        sd, m = F.col(f"_sd_{s}"), F.col(f"_m_{s}")
        zcols[f"{s}_zscore"] = F.when(sd > 0, (F.col(s) - m) / sd).otherwise(F.lit(0.0))
    out = out.withColumns(zcols)
    flags = {f"{s}_anomaly": F.when(F.abs(F.col(f"{s}_zscore")) > sigma, 1).otherwise(0)
             for s in sensors}
    out = out.withColumns(flags)
    score = sum((F.col(f"{s}_anomaly") for s in sensors), F.lit(0))
    out = out.withColumn("anomaly_score", score).withColumn(
        "is_anomaly", F.col("anomaly_score") >= min_sensors)
    return out.drop(*[f"_m_{s}" for s in sensors], *[f"_sd_{s}" for s in sensors])


def cross_sensor(df: DataFrame, **roles) -> DataFrame:
    """Five cross-sensor features (role names default to the pipeline's)."""
    return df.withColumns(cross_sensor_columns(**roles))


def silver_features(clean: DataFrame, profile: SensorProfile, windows: Sequence[int] = (12, 144),
                    lookback: int = 288, sigma: float = 3.0, min_sensors: int = 2,
                    cross_roles: dict | None = None, strategy: str = "chunked",
                    block_rows: int | None = None) -> DataFrame:
    """Feature tier in one blocked pass: rolling (W1), rate/acceleration
    (W2/W3), cross-sensor (S1, when roles are given) and z-score flags (W4).

    All windows share one partitioning (asset, block), so the plan has a
    single exchange for the whole tier.
    """
    sensors = list(profile.sensors)
    frame = _framed(clean, profile, max(max(windows), lookback, 2), 0, strategy, block_rows)
    frame = _carried(frame, keep_sequence=False)
    specs = [(f"{s}_rolling_{st}_{w}", s, w, st) for w in windows for s in sensors
             for st in ("mean", "std", "min", "max")]
    # lags first: they and the aggregates share one sort of the narrow rows
    out = frame.withColumns(_rate_cols(sensors, seq.ordered_window(profile)))
    rates = [c for c in out.columns if c not in frame.columns]
    out = seq.sliding_aggs(out, profile, specs + _zscore_specs(sensors, lookback))
    if cross_roles is not None:
        out = out.withColumns(cross_sensor_columns(**cross_roles))
    out = _with_zscores(out, sensors, sigma, min_sensors)
    rolled = [name for name, *_ in specs]
    out = out.select(*[c for c in frame.columns], *rolled, *rates,
                     *[c for c in out.columns if c not in {*frame.columns, *rolled, *rates}])
    return _finish(out, keep_sequence=False)


def fault_episodes(df: DataFrame, profile: SensorProfile, fault_col: str = "fault",
                   strategy: str = "chunked", block_rows: int | None = None) -> DataFrame:
    """One row per 0->1 transition (previous state of the first row is 0).

    Returns (asset, episode, start_ts, start_rn); ``episode`` numbers the
    starts of one asset from 1.  Counting and the first-10 list are
    ``groupBy``/``filter(episode <= 10)`` on this result.
    """
    frame = _framed(df, profile, 1, 0, strategy, block_rows)
    prev = F.lag(F.col(fault_col), 1, 0).over(seq.ordered_window(profile))
    starts = seq.drop_halo(frame.withColumn("_prev", prev)).filter(
        (F.col(fault_col) == 1) & (F.col("_prev") != 1))
    # number the starts per asset the same way (an asset that flips often may
    # have as many starts as a hot asset has rows)
    starts = starts.select(profile.asset, *profile.order_cols, F.col(seq.RN).alias("start_rn"))
    numbered = seq.number_rows(starts, profile, strategy=strategy, with_count=False)
    return numbered.select(profile.asset, F.col(seq.RN).alias("episode"),
                           F.col(profile.ts).alias("start_ts"), "start_rn")


def sequences(df: DataFrame, profile: SensorProfile, features: Sequence[str],
              targets: Sequence[str], seq_len: int = 48, horizon: int = 12,
              strategy: str = "chunked", block_rows: int | None = None) -> DataFrame:
    """Sliding training sequences.

    Row i (1-based) ending an input window yields ``x`` = features of rows
    i-seq_len+1..i (array of arrays) and ``y`` = targets of rows
    i+1..i+horizon, flattened step-major; only full windows are kept, so an
    asset of n rows gives n - seq_len - horizon + 1 sequences.
    """
    frame = _framed(df, profile, seq_len - 1, horizon, strategy, block_rows)
    w = seq.ordered_window(profile)
    past = w.rowsBetween(-(seq_len - 1), 0)
    future = w.rowsBetween(1, horizon)
    feat = F.array(*[F.col(c).cast("double") for c in features])
    targ = F.array(*[F.col(c).cast("double") for c in targets])
    out = frame.select(
        profile.asset, seq.RN, seq.CNT, seq.HALO, profile.ts,
        F.collect_list(feat).over(past).alias("x"),
        F.flatten(F.collect_list(targ).over(future)).alias("y"))
    out = seq.drop_halo(out)
    return out.filter((F.col(seq.RN) >= seq_len) & (F.col(seq.RN) + horizon <= F.col(seq.CNT))) \
        .select(profile.asset, F.col(seq.RN).alias("end_rn"), F.col(profile.ts).alias("end_ts"),
                "x", "y", (F.col(seq.RN) - seq_len + 1).alias("seq_idx"),
                (F.col(seq.CNT) - seq_len - horizon + 1).alias("n_seq"))


def chronological_split(df: DataFrame, profile: SensorProfile, validation: float = 0.2,
                        strategy: str = "chunked") -> DataFrame:
    """Mark the first (1 - validation) share of each asset's rows as train.

    Adds ``split`` = 'train' / 'validation'; the cut is floor(n * (1 - v)).
    Uses ``_rn``/``_cnt`` when present, else numbers the rows.
    """
    numbered = seq.RN in df.columns and seq.CNT in df.columns
    x = df if numbered else seq.number_rows(df, profile, strategy=strategy)
    cut = F.floor(F.col(seq.CNT) * (1 - validation))
    out = x.withColumn("split", F.when(F.col(seq.RN) <= cut, "train").otherwise("validation"))
    return out if numbered else out.drop(seq.RN, seq.CNT)


def split_sequences(seqs: DataFrame, validation: float = 0.2) -> DataFrame:
    """Mark the first (1 - validation) share of each asset's sequences as train.

    ``seqs`` comes from :func:`sequences`; the cut is floor(n_seq * (1 - v)).
    """
    cut = F.floor(F.col("n_seq") * (1 - validation))
    return seqs.withColumn("split", F.when(F.col("seq_idx") <= cut, "train").otherwise("validation"))
