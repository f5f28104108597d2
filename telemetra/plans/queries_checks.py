"""Queries that compose operators or feed them awkward rows: null keys, increments, rules with cooldown."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.operators import alerts as AL
from telemetra.operators import clean as C
from telemetra.operators import features as FT
from telemetra.operators import trend as TR
from telemetra.plans import catalog as cat
from telemetra.plans.batch import GateFailure, run_batch
from telemetra.plans.catalog import EVENTS, LINEITEM, LINEITEM_HEALTH, LINEITEM_SENSORS
from telemetra.plans.queries_core import rnd
from telemetra.plans.queries_more import _li_events, _rules_sql
from telemetra.plans.registry import register
from telemetra.plans.sqlgen import lineitem_clean_ctes, r, zscore_cte
from telemetra.session import scratch_path
from telemetra.sources import readers, sinks

_NULLED = """n AS (
  SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS user_id,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS ts,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM events)"""


def _nulled(spark, sf_dir):
    ev = cat.events_readings(spark, sf_dir)
    return ev.withColumns({
        "user_id": F.when(F.col("event_id") % 11 != 0, F.col("user_id")),
        "ts": F.when(F.col("event_id") % 13 != 0, F.col("ts")),
        "value": F.when(F.col("event_id") % 7 != 0, F.col("value"))})


@register("null_keys_rate", "W2 W3", f"""WITH {_NULLED}
SELECT event_id, user_id, (floor((value - lag(value) OVER w) * 16384.0 + 0.5) / 16384.0) AS value_rate_of_change,
  (floor(((value - lag(value) OVER w) - (lag(value) OVER w - lag(value, 2) OVER w)) * 16384.0 + 0.5) / 16384.0)
    AS value_acceleration
FROM n WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id)""")
def q_null_keys_rate(spark, sf_dir):
    x = FT.rate_of_change(_nulled(spark, sf_dir), EVENTS.with_(block_rows=16))
    return x.select("event_id", "user_id", rnd("value_rate_of_change").alias("value_rate_of_change"),
                    rnd("value_acceleration").alias("value_acceleration"))


@register("null_keys_clean", "C2 C3 C4 C5", f"""WITH {_NULLED},
d AS (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS rn FROM n),
r AS (SELECT event_id, user_id, ts, CASE WHEN value BETWEEN 0.0 AND 400.0 THEN value END AS value FROM d WHERE rn = 1),
f AS (SELECT event_id, user_id, ts, coalesce(value, lag(value) OVER (
        PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id)) AS value FROM r)
SELECT * FROM f WHERE value IS NOT NULL""")
def q_null_keys_clean(spark, sf_dir):
    x = C.clean_readings(_nulled(spark, sf_dir), EVENTS.with_(block_rows=16))
    return x.select("event_id", "user_id", "ts", "value")


@register("null_readings_physics", "C6", """SELECT l_orderkey, l_linenumber, l_partkey,
  (floor(least(greatest(l_discount / (t * 45 + 0.01) * 100 / 0.38, 50.0), 110.0) * 16384.0 + 0.5) / 16384.0)
    * CASE WHEN t IS NULL THEN NULL ELSE 1 END AS efficiency_pct
FROM (SELECT *, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_tax END AS t FROM lineitem)""")
def q_null_readings_physics(spark, sf_dir):
    x = cat.lineitem_readings(spark, sf_dir)
    x = x.withColumn("l_tax", F.when(F.col("l_linenumber") != 2, F.col("l_tax")))
    out = C.with_physics(x, discharge="l_extendedprice", inlet="l_quantity", fuel="l_tax", load="l_discount")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", rnd("efficiency_pct").alias("efficiency_pct"))


@register("null_readings_degradation", "S14 S15", """SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN q IS NULL THEN NULL ELSE
    (floor(least(greatest((q - 20.0) / (10.0 + 1e-10) / 5.0, 0.0), 1.0) * 16384.0 + 0.5) / 16384.0) END AS degradation,
  CASE WHEN q IS NULL THEN NULL ELSE (floor(least(1.0,
    exp(3 * least(greatest((q - 20.0) / (10.0 + 1e-10) / 5.0, 0.0), 1.0) - 2)) * 16384.0 + 0.5) / 16384.0) END AS probability
FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS q FROM lineitem)""")
def q_null_readings_degradation(spark, sf_dir):
    from telemetra.functions.scoring import failure_probability

    x = cat.lineitem_readings(spark, sf_dir)
    x = x.withColumn("l_quantity", F.when(F.col("l_linenumber") != 3, F.col("l_quantity")))
    out = TR.degradation_index(x, {"l_quantity": (20.0, 10.0)}, roles={"vibration_mm_s": "l_quantity"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", rnd("degradation").alias("degradation"),
                      rnd(failure_probability("degradation")).alias("probability"))


@register("rules_then_cooldown", "R1 R2 R3", f"""WITH RECURSIVE {_rules_sql()},
c AS (SELECT DISTINCT rule_id, l_suppkey, l_shipdate FROM ev),
chain AS (
  SELECT rule_id, l_suppkey, min(l_shipdate) AS l_shipdate FROM c GROUP BY 1, 2
  UNION ALL
  SELECT n.rule_id, n.l_suppkey, n.l_shipdate FROM chain p, LATERAL (
    SELECT c.rule_id, c.l_suppkey, min(c.l_shipdate) AS l_shipdate FROM c
    WHERE c.rule_id = p.rule_id AND c.l_suppkey = p.l_suppkey
      AND c.l_shipdate >= p.l_shipdate + INTERVAL 43200 MINUTE
    GROUP BY 1, 2) n)
SELECT * FROM chain""")
def q_rules_then_cooldown(spark, sf_dir):
    ev, _ = _li_events(spark, sf_dir)
    # the fold shuffles and writes its events whole: without the columns that nobody reads; events of one key and
    # time are then alike, and any of them may stand for the others
    ev = ev.select("rule_id", "l_suppkey", "l_shipdate")
    fired = AL.apply_cooldown(ev, "l_shipdate", ["l_suppkey", "rule_id"], id_col="rule_id", cooldown_col=None,
                              cooldown_minutes=43200)
    return fired.select("rule_id", "l_suppkey", "l_shipdate")


_S = ", ".join(LINEITEM_SENSORS)


@register("bronze_append", "IO1 IO7 IO10", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, {_S},
  'raw' AS data_quality_flag, year(l_shipdate) AS year, month(l_shipdate) AS month FROM lineitem""")
def q_bronze_append(spark, sf_dir):
    """Two increments of the same months, the first of them ingested twice."""
    run = uuid.uuid4().hex
    raw = cat.lineitem_readings(spark, sf_dir)
    target = scratch_path(spark, f"bronze_{run}")
    sources = []
    for part in range(2):
        sources.append(scratch_path(spark, f"raw_{run}_{part}"))
        raw.filter(F.col("l_orderkey") % 2 == part).write.parquet(sources[-1])
    for source in (sources[0], sources[1], sources[0]):
        got = readers.with_lineage(readers.read_readings(spark, source, raw.schema), ts=LINEITEM.ts, with_day=False)
        sinks.write_append(got, target, partitions=("year",), replace_sources=True)
    return spark.read.parquet(target).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", *LINEITEM_SENSORS,
        "data_quality_flag", F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"))


@register("bronze_ledger", "IO7 IO9 IO10", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, {_S},
  'file ' || (l_orderkey % 3) AS source_file, year(l_shipdate) AS year
FROM lineitem WHERE l_orderkey % 3 > 0 OR year(l_shipdate) <> 1995""")
def q_bronze_ledger(spark, sf_dir):
    """Three sources; the first comes again corrected, without a whole year; one commit is run twice."""
    raw = cat.lineitem_readings(spark, sf_dir).withColumns({
        "source_file": F.concat(F.lit("file "), (F.col("l_orderkey") % 3).cast("string")), "year": F.year("l_shipdate")})
    target = scratch_path(spark, f"ledger_{uuid.uuid4().hex}")
    for source in range(3):
        for _ in range(1 + source % 2):
            sinks.commit_sources(raw.filter(F.col("l_orderkey") % 3 == source), target, ("year",), batch=f"first-{source}")
    sinks.commit_sources(raw.filter((F.col("l_orderkey") % 3 == 0) & (F.col("year") != 1995)), target, ("year",),
                         batch="corrected")
    return sinks.read_committed(spark, target).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", *LINEITEM_SENSORS, "source_file",
        F.col("year").cast("long").alias("year"))


@register("assign_timestamps_text", "IO5", """SELECT o_orderkey,
  TIMESTAMP '2024-06-30 12:00:00' - to_seconds(CAST(30 * (count(*) OVER (PARTITION BY o_custkey)
    - row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderkey AS VARCHAR))) AS BIGINT)) AS timestamp
FROM orders""")
def q_assign_timestamps_text(spark, sf_dir):
    """Order by a text column, restarting per asset."""
    o = cat.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderkey").cast("string").alias("name"))
    out = readers.assign_timestamps(o, ["name"], "2024-06-30 12:00:00", step_seconds=30, asset="o_custkey")
    return out.select("o_orderkey", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


SCORE_RULES = (
    ("VALUE_HIGH", "value", "threshold_high", 100.0, 150.0, "value high", 30),
    ("ANOMALY", "anomaly_score", "anomaly_score", 0.25, 0.5, "unusual pattern", 30),
)


@register("scored_alerts", "R2 R1 R3 J1", f"""WITH RECURSIVE {_NULLED},
given AS (
  SELECT user_id, ts, least(abs(value - 50.0) / 50.0 / 5, 1.0) AS score FROM n WHERE event_id % 2 = 0
  UNION ALL SELECT user_id, ts, 0.3 FROM n WHERE event_id % 4 = 0),
top AS (SELECT user_id, ts, max(score) AS anomaly_score FROM given GROUP BY 1, 2),
m AS (SELECT n.*, anomaly_score FROM n LEFT JOIN top
      ON n.user_id IS NOT DISTINCT FROM top.user_id AND n.ts IS NOT DISTINCT FROM top.ts),
ev AS (
  SELECT 'VALUE_HIGH' AS rule_id, user_id, ts FROM m WHERE value >= 100
  UNION SELECT 'ANOMALY', user_id, ts FROM m WHERE anomaly_score >= 0.25),
chain AS (
  SELECT rule_id, user_id, min(ts) AS ts FROM ev WHERE ts IS NOT NULL GROUP BY 1, 2
  UNION ALL
  SELECT x.rule_id, x.user_id, x.ts FROM chain p, LATERAL (
    SELECT e.rule_id, e.user_id, min(e.ts) AS ts FROM ev e
    WHERE e.rule_id = p.rule_id AND e.user_id IS NOT DISTINCT FROM p.user_id AND e.ts >= p.ts + INTERVAL 30 MINUTE
    GROUP BY 1, 2) x)
SELECT * FROM chain""")
def q_scored_alerts(spark, sf_dir):
    """Readings with null keys, merged with repeated scores, through the rules, then the cooldown."""
    ev = _nulled(spark, sf_dir)
    score = F.least(F.abs(F.col("value") - 50.0) / 50.0 / 5, F.lit(1.0))
    scores = ev.filter("event_id % 2 = 0").select("user_id", "ts", score.alias("anomaly_score")) \
        .union(ev.filter("event_id % 4 = 0").select("user_id", "ts", F.lit(0.3)))
    long_df = AL.readings_long(ev, "user_id", "ts", ["value"], scores, ["anomaly_score"])
    alerts = AL.evaluate_rules(long_df, AL.rules_frame(spark, SCORE_RULES), "user_id", "ts")
    return AL.apply_cooldown(alerts, "ts", ["user_id", "rule_id"]).select("rule_id", "user_id", "ts")


@register("rule_admin", "R4 R5", """WITH c AS (
  SELECT l_partkey, l_quantity, l_linenumber % 3 > 0 AS on_, l_linenumber = 7 AS gone, row_number() OVER (
    PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS k FROM lineitem)
SELECT 'part ' || p_partkey AS rule_id, coalesce(CASE WHEN l_quantity < 40 THEN l_quantity END, p_retailprice) AS warning_threshold,
  p_retailprice * 2 AS critical_threshold, coalesce(on_, true) AS enabled
FROM part LEFT JOIN (SELECT * FROM c WHERE k = 1) ON l_partkey = p_partkey WHERE NOT coalesce(gone, false)""")
def q_rule_admin(spark, sf_dir):
    """A rule per part; the lines are its change log: threshold (null: as it was), switch, deletion."""
    rules = cat.table(spark, sf_dir, "part").select(
        F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("rule_id"),
        F.col("p_retailprice").alias("warning_threshold"), (F.col("p_retailprice") * 2).alias("critical_threshold"),
        F.lit(True).alias("enabled"))
    log = cat.lineitem_readings(spark, sf_dir).select(
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("rule_id"), "l_shipdate", "l_orderkey",
        "l_linenumber", "l_quantity", F.when(F.col("l_quantity") < 40, F.col("l_quantity")).alias("warning_threshold"),
        (F.col("l_linenumber") % 3 > 0).alias("enabled"), (F.col("l_linenumber") == 7).alias("deleted"))
    return AL.apply_changes(rules, log, "rule_id", ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"])


_ACKED = """a AS (
  SELECT o.o_orderkey, o.o_orderdate, CASE WHEN o_orderstatus = 'F' THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
         max(l_shipdate) AS last_ack
  FROM orders o LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON l_orderkey = o_orderkey GROUP BY ALL),
b AS (SELECT l_orderkey, l_shipdate, max(l_suppkey) AS who FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)"""


def _acked(spark, sf_dir):
    alerts = cat.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.when(F.col("o_orderstatus") == "F", "CRITICAL").otherwise("WARNING").alias("severity"),
        F.lit(False).alias("acknowledged"))
    acks = cat.lineitem_readings(spark, sf_dir).filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("acknowledged_by"),
        F.col("l_shipdate").alias("acknowledged_at"))
    return AL.apply_acks(alerts, acks, "o_orderkey")


@register("acked_alerts", "R7", f"""WITH {_ACKED}
SELECT o_orderkey, severity, last_ack IS NOT NULL AS acknowledged, who AS acknowledged_by
FROM a LEFT JOIN b ON l_orderkey = o_orderkey AND l_shipdate = last_ack""")
def q_acked_alerts(spark, sf_dir):
    return _acked(spark, sf_dir).select("o_orderkey", "severity", "acknowledged", "acknowledged_by")


@register("filtered_alerts", "R11 A9", f"""WITH {_ACKED}
SELECT year(o_orderdate) AS year, count(*) AS total_active, min(o_orderdate) AS first_alert, max(o_orderdate) AS last_alert
FROM a WHERE severity = 'CRITICAL' AND last_ack IS NULL GROUP BY 1""")
def q_filtered_alerts(spark, sf_dir):
    """Critical alerts that nobody has acknowledged, by year."""
    open_ = AL.filter_alerts(_acked(spark, sf_dir).withColumnRenamed("acknowledged", "resolved"), "CRITICAL", active_only=True)
    out = AL.alert_summary(open_.withColumn("year", F.year("o_orderdate")), ["year"], "o_orderdate")
    return out.select("year", "total_active", "first_alert", "last_alert")


@register("batch_flow", "P8 P7 IO8 W1 W2 W4 A1", f"""WITH {lineitem_clean_ctes()},
{zscore_cte('clean', 'silver', 'l_suppkey', 'l_shipdate', LINEITEM_SENSORS)}
SELECT l_suppkey, date_trunc('month', l_shipdate) AS month_bucket, count(*) AS reading_count,
  CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
  (floor(avg(l_quantity) * 16384.0 + 0.5) / 16384.0) AS l_quantity_avg, max(l_tax) AS l_tax_max
FROM silver GROUP BY 1, 2""")
def q_batch_flow(spark, sf_dir):
    """The batch flow: stopped by a gate after the feature tier, started again, and read back."""
    base, run = scratch_path(spark, f"flow_{uuid.uuid4().hex}"), uuid.uuid4().hex
    raw = cat.lineitem_readings(spark, sf_dir)

    def start(**limits):
        return run_batch(spark, raw, None, LINEITEM, base, dict(LINEITEM_HEALTH), kpi_grain="month",
                         bucket_col="month_bucket", run=run, gate_config={
                             "max_duplicate_percentage": 100.0, "required_tables": ("gold_turbine_hourly_kpis",)} | limits)

    try:
        start(required_features_count=1000)
    except GateFailure:
        start()
    return spark.read.parquet(f"{base}/gold_kpis").select(
        "l_suppkey", F.col("month_bucket").cast("timestamp_ntz").alias("month_bucket"), "reading_count", "anomaly_count",
        rnd("l_quantity_avg").alias("l_quantity_avg"), "l_tax_max")


# ---------------------------------------------------------------------------
# T6-T8, W8, IO13: forecaster trained, saved, loaded and measured
# ---------------------------------------------------------------------------

def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether both have the same rows, as often, and any at all; each is computed once."""
    both = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    off = both.groupBy(*left.columns).agg(F.sum("_side").alias("_off")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_off") != 0).alias("off")).first()
    return off["rows"] > 0 and off["off"] == 0


@register("forecaster", "T6 T7 T8 W7 W8 IO13", f"""
WITH e AS (
  SELECT user_id, coalesce(value, 0.0) AS v, row_number() OVER o AS rn, count(*) OVER (PARTITION BY user_id) AS cnt,
         lead(coalesce(value, 0.0), 1) OVER o AS y1, lead(coalesce(value, 0.0), 2) OVER o AS y2
  FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)),
w AS (
  SELECT v, y1, y2, CASE WHEN rn - 11 <= floor((cnt - 13) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'validation' END
         AS split
  FROM e WHERE rn >= 12 AND rn + 2 <= cnt),
y AS (SELECT 1 AS step, split, abs(v - y1) AS err FROM w UNION ALL SELECT 2, split, abs(v - y2) FROM w)
SELECT CAST(step AS BIGINT) AS step, split, count(*) AS n, {r('avg(err)')} AS naive_mae,
       true AS beats_naive, true AS same_after_load
FROM y GROUP BY step, split""")
def q_forecaster(spark, sf_dir):
    """Windows of 12 readings, 2 steps ahead; the error is compared with that of the last reading as forecast."""
    ev = cat.events_readings(spark, sf_dir)
    model, metrics = TR.train_forecaster(ev, EVENTS, ["value"], ["value"], seq_len=12, horizon=2,
                                         loss="squaredError")
    path = scratch_path(spark, f"forecaster-{uuid.uuid4().hex}")
    sinks.save_forecaster(model, spark, path)
    fitted = TR.forecast(model, ev, EVENTS)
    loaded = TR.forecast(sinks.load_forecaster(spark, path), ev, EVENTS)
    same = same_rows(fitted, loaded)
    return metrics.select((F.col("output") + 1).cast("long").alias("step"), "split", "n",
                          rnd("naive_mae").alias("naive_mae"), (F.col("mae") < F.col("naive_mae")).alias("beats_naive"),
                          F.lit(same).alias("same_after_load"))
