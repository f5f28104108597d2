"""Alert rules, evaluation, cooldown and alarm derivation.

Rule tables are configuration DataFrames (rule_id, sensor_name, rule_type,
warning_threshold, critical_threshold, description, cooldown_minutes,
enabled).  They are broadcast only after their size is checked.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.functions.scoring import rule_severity
from telemetra.operators.cooldown import fired
from telemetra.operators.sequence import null_safe_join
from telemetra.profile import (ALARM_CODES, DEFAULT_COOLDOWN_MINUTES, DEFAULT_RULES,
                               DERIVED_ALARMS, SEVERITY_COLOURS)
from telemetra.session import cut_lineage

RULE_SCHEMA = T.StructType([
    T.StructField("rule_id", T.StringType(), False),
    T.StructField("sensor_name", T.StringType(), False),
    T.StructField("rule_type", T.StringType(), False),
    T.StructField("warning_threshold", T.DoubleType(), False),
    T.StructField("critical_threshold", T.DoubleType(), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("cooldown_minutes", T.IntegerType(), False),
    T.StructField("enabled", T.BooleanType(), False),
])

RULE_TYPES = ("threshold_high", "threshold_low", "anomaly_score", "failure_probability",
              "rate_of_change")
BROADCAST_MAX_ROWS = 100_000


def rules_frame(spark: SparkSession, rules: Iterable[tuple]) -> DataFrame:
    """Rules from tuples (id, sensor, type, warn, crit, description[, cooldown, enabled])."""
    rows = []
    for r in rules:
        r = tuple(r)
        if r[2] not in RULE_TYPES:
            raise ValueError(f"unknown rule type {r[2]!r}")
        cd = r[6] if len(r) > 6 else DEFAULT_COOLDOWN_MINUTES
        en = r[7] if len(r) > 7 else True
        rows.append((r[0], r[1], r[2], float(r[3]), float(r[4]), r[5], int(cd), bool(en)))
    return spark.createDataFrame(rows, RULE_SCHEMA)


def default_rules(spark: SparkSession) -> DataFrame:
    """The seven default rules."""
    return rules_frame(spark, DEFAULT_RULES)


def merge_rules(base: DataFrame, changes: DataFrame) -> DataFrame:
    """add/replace rules by rule_id (changes win), e.g. to enable/disable."""
    kept = base.join(changes.select("rule_id"), on="rule_id", how="left_anti")
    return kept.unionByName(changes.select(*base.columns))


def apply_changes(base: DataFrame, log: DataFrame, id_col: str, order: Sequence[str]) -> DataFrame:
    """``base`` after a log of changes, the latest change per ``id_col`` winning.

    ``log`` has ``id_col``, the ``order`` columns (time, then a number that
    tells changes of one time apart; nulls are earliest), columns of ``base``
    (null: unchanged), and may have ``deleted``.  Of an id that ``base`` lacks
    a row is added.  Changes are reduced before they are joined, so that an id
    that is changed very often costs one row per task.
    """
    fields = [c for c in base.columns if c != id_col and c in log.columns]
    gone = F.col("deleted") if "deleted" in log.columns else F.lit(False)
    latest = log.groupBy(id_col).agg(F.max(F.struct(
        *[F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("at")).alias(f"_{i}") for i, c in enumerate(order)],
        F.struct(*[F.col(c) for c in fields], F.coalesce(gone, F.lit(False)).alias("_gone")).alias("_new"))).alias("_c"))
    joined = base.withColumn("_here", F.lit(True)).join(latest, id_col, "full")
    new = F.col("_c._new")
    return joined.filter(~F.coalesce(new["_gone"], F.lit(False))).select(
        *[F.col(c) if c == id_col or c not in fields else F.coalesce(new[c], F.col(c)).alias(c) for c in base.columns])


def set_enabled(rules: DataFrame, rule_id: str, enabled: bool) -> DataFrame:
    """Enable or disable one rule."""
    return rules.withColumn("enabled", F.when(F.col("rule_id") == rule_id, F.lit(enabled))
                            .otherwise(F.col("enabled")))


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast a configuration table only when its row count is within bound."""
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def readings_long(readings: DataFrame, asset: str, ts: str, sensors: Sequence[str],
                  scores: DataFrame | None = None, score_cols: Sequence[str] = (),
                  keep: Sequence[str] = ()) -> DataFrame:
    """Readings (optionally merged with model scores on asset and time; scores
    win on a name clash) as (asset, ts, sensor_name, value); nulls dropped.

    A null asset or time meets the scores of the same nulls.  Of several
    scores of one asset and time the highest counts, so that a reading is
    never repeated.
    """
    wide = readings
    names = list(sensors)
    if scores is not None:
        clash = [c for c in score_cols if c in wide.columns]
        highest = scores.groupBy(asset, ts).agg(*[F.max(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")))
                                                  .alias(c) for c in score_cols])
        wide = null_safe_join(wide.drop(*clash), highest, [asset, ts], "left")
        names = [c for c in names if c not in score_cols] + list(score_cols)
    long_df = wide.select(asset, ts, *keep, *[F.col(c).cast("double").alias(c) for c in names]) \
        .unpivot([asset, ts, *keep], names, "sensor_name", "value")
    return long_df.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def match_rules(long_df: DataFrame, rules: DataFrame) -> DataFrame:
    """Pair each value with the enabled rules for its sensor (broadcast
    equi-join on sensor name after a size check)."""
    enabled = rules.filter(F.col("enabled"))
    return long_df.join(checked_broadcast(enabled), on="sensor_name", how="inner")


def evaluate_rules(long_df: DataFrame, rules: DataFrame, asset: str, ts: str,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Violations with severity, the crossed threshold and a
    deterministic alert id (sha2 of asset, rule, time)."""
    m = match_rules(long_df, rules)
    sev = rule_severity("rule_type", "value", "warning_threshold", "critical_threshold")
    m = m.withColumn("severity", sev).filter(F.col("severity").isNotNull())
    thr = F.when(F.col("severity") == "CRITICAL", F.col("critical_threshold")).otherwise(
        F.col("warning_threshold"))
    aid = F.sha2(F.concat_ws("|", F.col(asset).cast("string"), F.col("rule_id"),
                             F.col(ts).cast("string")), 256)
    return m.select(aid.alias("alert_id"), "rule_id", F.col(asset), *keep, "sensor_name", "severity",
                    "value", thr.alias("threshold"), F.col("description").alias("message"),
                    F.col(ts), "cooldown_minutes", F.lit(False).alias("acknowledged"))


def apply_cooldown(events: DataFrame, ts: str, key_cols: Sequence[str], id_col: str = "alert_id",
                   cooldown_col: str | None = "cooldown_minutes",
                   cooldown_minutes: float | None = None) -> DataFrame:
    """Greedy cooldown -- an event fires when no event of its key fired
    in the last ``cooldown`` (ts - last_fired >= cooldown fires).

    Of events of one key at one instant only the first by ``id_col`` can fire
    (with a cooldown of 0 all events fire), so a place in the chain is a (key,
    time) pair, whatever the ids.  The chain is a fold over the places of a
    key, computed by composing the step functions of segments
    (:mod:`telemetra.operators.cooldown`); no key is ordered in one task.
    An event without a time is no place and does not fire.

    ``key_cols`` = (asset, rule) for per-asset cooldown, or (rule,) for the
    source behaviour where one asset silences the others; null keys are a key.
    One cooldown per key is required (taken from ``cooldown_col`` or
    ``cooldown_minutes``).
    """
    key = list(key_cols)
    minutes = F.lit(float(cooldown_minutes)) if cooldown_minutes is not None else F.col(cooldown_col).cast("double")
    ev = events.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp"))) \
        .withColumn("_L", (minutes * 60_000_000).cast("long"))
    always = ev.filter("_L <= 0").select(*events.columns)
    rest = [c for c in events.columns if c != id_col and c not in key]
    places = ev.filter("_L > 0 and _t is not null").groupBy(F.struct(*key).alias("_key"), "_t").agg(
        F.min("_L").alias("_L"), F.min(F.struct(id_col, *rest)).alias("_row"))
    out = fired(places, "_key", "_t", "_L")
    named = [F.col(f"_key.{c}").alias(c) if c in key else F.col(f"_row.{c}").alias(c) for c in events.columns]
    return out.select(*named).unionByName(always)


def alert_log(events: DataFrame, ts: str, limit: int = 100) -> DataFrame:
    """The ``limit`` most recent events (a top-k report)."""
    return events.orderBy(F.col(ts).desc(), F.col("alert_id").desc()).limit(limit)


def order_alerts(events: DataFrame, ts: str) -> DataFrame:
    """Newest first."""
    return events.orderBy(F.col(ts).desc())


def apply_acks(events: DataFrame, acks: DataFrame, id_col: str = "alert_id") -> DataFrame:
    """Mark events acknowledged by the latest ack per id (acks: id, by, at; of one time the largest name)."""
    latest = acks.groupBy(id_col).agg(F.max(F.struct("acknowledged_at", "acknowledged_by")).alias("_a"))
    j = events.join(latest, on=id_col, how="left")
    return j.withColumn("acknowledged", F.col("acknowledged") | F.col("_a").isNotNull()) \
        .withColumn("acknowledged_by", F.col("_a.acknowledged_by")).drop("_a")


def derive_alarms(readings: DataFrame, asset: str, ts: str,
                  defs: Mapping[str, tuple[str, str, float]] = DERIVED_ALARMS,
                  codes: Mapping[str, tuple[str, str]] = ALARM_CODES) -> DataFrame:
    """Alarms from readings with strict > / < thresholds, keeping each
    row's own asset; description and severity from the code table."""
    spark = readings.sparkSession
    rows = [(code, sensor, op, float(thr), codes[code][0], codes[code][1])
            for code, (sensor, op, thr) in defs.items()]
    d = spark.createDataFrame(rows, "alarm_code string, sensor_name string, op string, "
                                    "threshold double, alarm_description string, severity string")
    sensors = sorted({s for _, s, _, _, _, _ in rows if s in readings.columns})
    long_df = readings_long(readings, asset, ts, sensors)
    j = long_df.join(F.broadcast(d), on="sensor_name", how="inner")  # fixed size: code table
    hit = ((F.col("op") == ">") & (F.col("value") > F.col("threshold"))) | (
        (F.col("op") == "<") & (F.col("value") < F.col("threshold")))
    return j.filter(hit).select(F.col(ts).alias("timestamp"), F.col(asset).alias("turbine_id"),
                                "alarm_code", "alarm_description", "severity",
                                F.col("value").alias("sensor_value"), "threshold")


def alert_payload(events: DataFrame, asset: str = "turbine_id", ts: str = "timestamp") -> DataFrame:
    """Notification payload as JSON (colour by severity, 3-decimal facts)."""
    colours = F.create_map(*[x for k, v in SEVERITY_COLOURS.items() for x in (F.lit(k), F.lit(v))])
    facts = F.array(
        F.struct(F.lit("Turbine").alias("title"), F.col(asset).cast("string").alias("value")),
        F.struct(F.lit("Sensor").alias("title"), F.col("sensor_name").alias("value")),
        F.struct(F.lit("Value").alias("title"), F.format_string("%.3f", "value").alias("value")),
        F.struct(F.lit("Threshold").alias("title"),
                 F.format_string("%.3f", "threshold").alias("value")),
        F.struct(F.lit("Time").alias("title"), F.col(ts).cast("string").alias("value")))
    body = F.struct(
        F.coalesce(colours[F.col("severity")], F.lit("888888")).alias("color"),
        F.concat(F.col("severity"), F.lit(" Alert – "), F.col("sensor_name")).alias("title"),
        F.when(F.col("severity").isin("HIGH", "CRITICAL"), "Attention").otherwise("Default")
        .alias("emphasis"),
        facts.alias("facts"), F.col("message").alias("text"))
    return events.select("alert_id", F.to_json(body).alias("payload"))


def fault_alerts(readings: DataFrame, asset: str, ts: str, fault_col: str,
                 baselines: Mapping[str, tuple[float, float]], last_n: int | None = 20,
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """Alerts for fault rows: worst sensor by baseline z (first listed
    wins ties), CRITICAL when z > 3 else WARNING, code ALM- + 6 letters.

    ``last_n`` keeps the newest fault rows per asset (a top-k report); the
    input should already be the time window of interest.
    """
    names = list(baselines)
    zs = [F.struct(F.abs((F.col(s) - m) / sd).alias("z"), F.lit(-i).alias("neg_pos"),
                   F.lit(s).alias("sensor"), F.col(s).cast("double").alias("v"),
                   F.lit(float(m)).alias("mean"))
          for i, (s, (m, sd)) in enumerate(baselines.items())]
    faults = readings.filter(F.col(fault_col) == 1)
    if last_n is not None:
        from telemetra.operators.lastn import last_n_rows
        from telemetra.profile import SensorProfile
        faults = last_n_rows(faults, SensorProfile(asset=asset, ts=ts, sensors=tuple(names),
                                                   tiebreak=tuple(tiebreak)), last_n)
    worst = F.array_max(F.filter(F.array(*zs), lambda x: x["z"].isNotNull() & (x["z"] > 0)))
    out = faults.withColumn("_w", worst)
    z = F.coalesce(F.col("_w.z"), F.lit(0.0))
    sensor = F.coalesce(F.col("_w.sensor"), F.lit(""))
    return out.select(
        F.col(ts).alias("timestamp"), F.col(asset).alias("turbine_id"),
        F.concat(F.lit("ALM-"), F.upper(F.substring(sensor, 1, 6))).alias("alarm_code"),
        sensor.alias("worst_sensor"), F.round(z, 4).alias("z"),
        F.when(z > 3, "CRITICAL").otherwise("WARNING").alias("severity"),
        F.round(F.coalesce(F.col("_w.v"), F.lit(0.0)), 2).alias("sensor_value"),
        F.round(F.coalesce(F.col("_w.mean"), F.lit(0.0)), 2).alias("threshold"))


def filter_alerts(alerts: DataFrame, severity: str | None = None, active_only: bool = False,
                  resolved_col: str = "resolved") -> DataFrame:
    """Severity filter and unresolved-only filter (which needs ``resolved_col``)."""
    out = alerts
    if active_only and resolved_col not in alerts.columns:
        raise ValueError(f"no column {resolved_col!r} tells which alerts are active")
    if severity:
        out = out.filter(F.col("severity") == severity)
    if active_only:
        out = out.filter(~F.coalesce(F.col(resolved_col), F.lit(False)))
    return out


def alert_summary(alerts: DataFrame, group_cols: Sequence[str] = ("turbine_id",),
                  ts: str = "timestamp") -> DataFrame:
    """Counts by severity, first and last alert time (``last_alert`` in the
    source is actually the oldest; both ends are given)."""
    return alerts.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("total_active"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical"),
        F.count_if(F.col("severity") == "WARNING").alias("warning"),
        F.count_if(F.col("severity") == "INFO").alias("info"),
        F.min(ts).alias("first_alert"), F.max(ts).alias("last_alert"))
