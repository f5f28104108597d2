"""Registered queries: statistics, latest-N, scoring, alerts, trends, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.functions import scoring as SC
from telemetra.operators import alerts as AL
from telemetra.operators import clean as C
from telemetra.operators import drift as DR
from telemetra.operators import features as FT
from telemetra.operators import lastn as LN
from telemetra.operators import stats as ST
from telemetra.operators import trend as TR
from telemetra.plans import catalog as cat
from telemetra.plans.catalog import EVENTS, LINEITEM, LINEITEM_SENSORS
from telemetra.plans.queries_core import rnd
from telemetra.plans.registry import register
from telemetra.plans.sqlgen import r, sround

S = LINEITEM_SENSORS
LI_ORDER = "l_shipdate, " + ", ".join(LINEITEM.tiebreak)
LI_UNPIVOT = ("(UNPIVOT (SELECT * FROM lineitem) ON l_quantity, l_extendedprice, l_discount, "
              "l_tax INTO NAME sensor VALUE value)")


# ---------------------------------------------------------------------------
# A6-A8, A11-A14, J5
# ---------------------------------------------------------------------------

STAT_COLS = ["mean", "std", "min", "max", "p25", "p50", "p75"]


@register("summary_stats", "A6", f"""SELECT l_suppkey, sensor,
  {r('avg(value)')} AS mean, {r('stddev_samp(value)')} AS std, min(value) AS min,
  max(value) AS max, {r('quantile_cont(value, 0.25)')} AS p25,
  {r('quantile_cont(value, 0.5)')} AS p50, {r('quantile_cont(value, 0.75)')} AS p75,
  count(value) AS count
FROM {LI_UNPIVOT} GROUP BY 1, 2""")
def q_summary_stats(spark, sf_dir):
    long_df = ST.unpivot(cat.lineitem_readings(spark, sf_dir), S, id_cols=["l_suppkey"])
    out = ST.summary_stats(long_df, ["l_suppkey", "sensor"], decimals=None)
    return out.withColumns({c: rnd(c) for c in STAT_COLS if c not in ("min", "max")})


@register("last_n_stats", "J2 A6", f"""WITH t AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {LI_ORDER} DESC)
                 AS k FROM lineitem) WHERE k <= 50),
u AS (SELECT l_suppkey, sensor, value FROM (UNPIVOT t ON l_quantity, l_extendedprice, l_discount,
      l_tax INTO NAME sensor VALUE value))
SELECT sensor, {r('avg(value)')} AS mean, {r('stddev_samp(value)')} AS std, min(value) AS min,
  max(value) AS max, {r('quantile_cont(value, 0.25)')} AS p25,
  {r('quantile_cont(value, 0.5)')} AS p50, {r('quantile_cont(value, 0.75)')} AS p75,
  count(value) AS count
FROM u GROUP BY 1""".replace(f"{LI_ORDER} DESC", ", ".join(
    f"{c} DESC" for c in LI_ORDER.split(", "))))
def q_last_n_stats(spark, sf_dir):
    last = LN.last_n_rows(cat.lineitem_readings(spark, sf_dir), LINEITEM, 50)
    out = ST.summary_stats(ST.unpivot(last, S), ["sensor"], decimals=None)
    return out.withColumns({c: rnd(c) for c in STAT_COLS if c not in ("min", "max")})


def _fault_sql():
    return f"""WITH u AS (SELECT l_suppkey, sensor, value, l_returnflag = 'R' AS f FROM {LI_UNPIVOT}),
g AS (
  SELECT l_suppkey, sensor,
    CASE WHEN count(*) FILTER (WHERE f) > 0 THEN avg(value) FILTER (WHERE f) ELSE 0.0 END AS fm,
    CASE WHEN count(*) FILTER (WHERE NOT f) > 0 THEN avg(value) FILTER (WHERE NOT f) ELSE 0.0 END AS nm,
    CASE WHEN count(*) FILTER (WHERE NOT f) > 1 THEN stddev_samp(value) FILTER (WHERE NOT f) ELSE 1.0 END AS ns
  FROM u GROUP BY 1, 2),
z AS (SELECT *, abs(fm - nm) / greatest(ns, 0.001) AS zd FROM g)
SELECT l_suppkey, sensor, {r('fm')} AS fault_mean, {r('nm')} AS normal_mean,
  {r('zd')} AS z_difference, zd > 1.5 AS significant,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY zd DESC, sensor) AS rank
FROM z"""


@register("fault_analysis", "A7", _fault_sql())
def q_fault_analysis(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir).withColumn(
        "fault", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    ranking, _ = ST.fault_analysis(li, S, "fault", group_cols=["l_suppkey"], decimals=12)
    return ranking.withColumns({c: rnd(c) for c in ("fault_mean", "normal_mean", "z_difference")})


@register("fault_overview", "A7", """SELECT l_suppkey, count(*) AS total_rows,
  count(*) FILTER (WHERE l_returnflag = 'R') AS fault_count,
  count(*) FILTER (WHERE l_returnflag <> 'R') AS normal_count,
  round(count(*) FILTER (WHERE l_returnflag = 'R') / greatest(count(*), 1), 4) AS fault_rate
FROM lineitem GROUP BY 1""")
def q_fault_overview(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir).withColumn(
        "fault", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    _, ov = ST.fault_analysis(li, S, "fault", group_cols=["l_suppkey"])
    return ov.select("l_suppkey", F.col("total_rows").cast("long"),
                     F.col("fault_count").cast("long"), F.col("normal_count").cast("long"),
                     "fault_rate")


CORR_PAIRS = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"),
              ("l_quantity", "l_discount"), ("l_extendedprice", "l_tax")]


def _corr_sql(raw: bool = False):
    parts = []
    for a, b in CORR_PAIRS:
        rr = f"corr({a}, {b})"
        lab = (f"CASE WHEN {rr} IS NULL OR isnan({rr}) THEN NULL WHEN {rr} > 0.7 THEN 'strong positive' "
               f"WHEN {rr} > 0.3 THEN 'moderate positive' WHEN {rr} > -0.3 THEN 'weak/no' "
               f"WHEN {rr} > -0.7 THEN 'moderate negative' ELSE 'strong negative' END")
        parts.append(f"SELECT l_suppkey, '{a}' AS sensor_a, '{b}' AS sensor_b, "
                     f"coalesce({rr if raw else r(rr)}, 0.0) AS pearson_r, {lab} AS interpretation, "
                     f"count({a}) AS data_points FROM lineitem GROUP BY 1")
    return "\nUNION ALL\n".join(parts)


@register("sensor_correlation", "A8", _corr_sql())
def q_sensor_correlation(spark, sf_dir):
    out = ST.sensor_correlation(cat.lineitem_readings(spark, sf_dir), CORR_PAIRS,
                                group_cols=["l_suppkey"], decimals=12)
    return out.withColumn("pearson_r", rnd("pearson_r"))


@register("tag_counts", "A11", """SELECT tag, count(*) AS count FROM (
  SELECT trim(unnest(string_split(p_name, ' '))) AS tag FROM part) WHERE tag <> '' GROUP BY 1""")
def q_tag_counts(spark, sf_dir):
    return ST.tag_counts(cat.table(spark, sf_dir, "part"), "p_name", sep=" ")


@register("tags_per_row", "A12", """SELECT len(list_filter(list_transform(string_split(p_type, ' '),
  lambda x: trim(x)), lambda x: x <> '')) AS selections, count(*) AS rows
FROM part WHERE p_type IS NOT NULL AND p_type <> '' GROUP BY 1""")
def q_tags_per_row(spark, sf_dir):
    return ST.tags_per_row(cat.table(spark, sf_dir, "part"), "p_type", sep=" ")


@register("calibrate_baseline", "A13 C11", f"""SELECT sensor, {r('avg(value)')} AS mean,
  {r('stddev_samp(value)')} AS std, count(value) AS n, {r('quantile_cont(value, 0.05)')} AS p05,
  {r('quantile_cont(value, 0.95)')} AS p95
FROM {LI_UNPIVOT} WHERE l_returnflag <> 'R' GROUP BY 1
HAVING (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'R') >= 100""")
def q_calibrate(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir)
    out = ST.calibrate(C.only_normal(li, LINEITEM), S, min_rows=100)
    return out.select("sensor", rnd("mean").alias("mean"), rnd("std").alias("std"),
                      F.col("n").cast("long").alias("n"), rnd("p05").alias("p05"),
                      rnd("p95").alias("p95"))


@register("drift_baseline", "A14", f"""SELECT event_type AS feature, {r('avg(value)')} AS mean,
  {r('stddev_samp(value)')} AS std, count(value) AS n, {r('median(value)')} AS median,
  {r('quantile_cont(value, 0.05)')} AS p05, {r('quantile_cont(value, 0.95)')} AS p95
FROM events WHERE ts < TIMESTAMP '{cat.DRIFT_SPLIT}' GROUP BY 1""")
def q_drift_baseline(spark, sf_dir):
    ev = cat.events_readings(spark, sf_dir).filter(F.col("ts") < F.lit(cat.DRIFT_SPLIT).cast("timestamp_ntz"))
    # one "feature" per event type: value of that type
    long_df = ev.select(F.col("event_type").alias("feature"), "value")
    out = ST.baseline_stats(long_df, ["feature"], with_median=True)
    return out.select("feature", *[rnd(c).alias(c) for c in ("mean", "std")],
                      F.col("n").cast("long").alias("n"),
                      *[rnd(c).alias(c) for c in ("median", "p05", "p95")])


@register("largest_asset", "J5", """SELECT l_suppkey, count(*) AS rows FROM lineitem
GROUP BY 1 ORDER BY rows DESC, l_suppkey LIMIT 1""")
def q_largest_asset(spark, sf_dir):
    out = ST.largest_asset(cat.lineitem_readings(spark, sf_dir), LINEITEM)
    return out.select("l_suppkey", F.col("rows").cast("long"))


# ---------------------------------------------------------------------------
# J2-J4, A10, W6-W8
# ---------------------------------------------------------------------------

@register("sensor_trend", "J2 J3", """SELECT user_id, ts AS timestamp, round(value, 4) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events)
WHERE k <= 24""")
def q_sensor_trend(spark, sf_dir):
    return LN.sensor_trend(cat.events_readings(spark, sf_dir), EVENTS, "value", 24)


@register("query_readings", "J4", """SELECT user_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k
  FROM events WHERE event_type = 'error') WHERE k <= 20""")
def q_query_readings(spark, sf_dir):
    return LN.query_readings(cat.events_readings(spark, sf_dir), EVENTS, n=20, fault_only=True,
                             extra=["event_type"])


def _events_health_cols():
    return {"health_score": SC.baseline_health(EVENTS.baselines, fault=EVENTS.fault_col()),
            "anomaly_score": SC.baseline_anomaly(EVENTS.baselines)}


_EV_Z = "abs((value - 50.0) / 50.0)"
_EV_HEALTH = (f"least(greatest(100 - (CASE WHEN {_EV_Z} > 3 THEN 25 WHEN {_EV_Z} > 2 THEN 10 "
              f"WHEN {_EV_Z} > 1.5 THEN 3 ELSE 0 END + CASE WHEN event_type = 'error' THEN 30 ELSE 0 END),"
              f" 0.0), 100.0)")
_EV_ANOM = f"least(greatest({_EV_Z} / 1 / 5.0, 0.0), 1.0)"


@register("latest_status_alerts", "A10 S7 S8", f"""WITH t AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k,
         {_EV_HEALTH} AS health_score FROM events)
SELECT user_id, arg_max(ts, k * -1) AS ts, arg_max(health_score, -k) AS health_score,
  {r('arg_max(value, -k)')} AS value,
  CASE WHEN arg_max(health_score, -k) >= 80 THEN 'LOW' WHEN arg_max(health_score, -k) >= 60 THEN 'MEDIUM'
       WHEN arg_max(health_score, -k) >= 40 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level,
  count(*) FILTER (WHERE event_type = 'error') AS active_alerts
FROM t WHERE k <= 30 GROUP BY 1""")
def q_latest_status_alerts(spark, sf_dir):
    ev = cat.events_readings(spark, sf_dir).withColumns(_events_health_cols())
    st = LN.latest_status(ev.select("event_id", "ts", "user_id", "event_type", "value",
                                    "health_score"), EVENTS, window_rows=30)
    return st.select("user_id", "ts", "health_score", rnd("value").alias("value"),
                     SC.risk_level("health_score").alias("risk_level"), "active_alerts")


@register("baseline_scores", "S8 S9 S12", f"""SELECT event_id, {_EV_HEALTH} AS health_score,
  {r(_EV_ANOM)} AS anomaly_score,
  CASE WHEN {_EV_ANOM} > 0.7 THEN 'CRITICAL' WHEN {_EV_ANOM} > 0.4 THEN 'WARNING'
       WHEN {_EV_ANOM} > 0.2 THEN 'ELEVATED' ELSE 'NORMAL' END AS anomaly_label
FROM events""")
def q_baseline_scores(spark, sf_dir):
    ev = cat.events_readings(spark, sf_dir).withColumns(_events_health_cols())
    return ev.select("event_id", "health_score", rnd("anomaly_score").alias("anomaly_score"),
                     SC.anomaly_label("anomaly_score").alias("anomaly_label"))


def _anomaly_result_sql():
    zs = [f"abs(({s} - {m}) / {sd})" for s, (m, sd) in LINEITEM.baselines.items()]
    avg = "(" + " + ".join(zs) + f") / {len(zs)}"
    score = f"least(1.0, {avg} / 5.0)"
    contrib = " + ".join(f"CASE WHEN {z} > 2.5 THEN 1 ELSE 0 END" for z in zs)
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
  {r(score)} AS anomaly_score, {r('-(' + avg + ')')} AS raw_score,
  {score} > 0.7 AS is_anomaly, {contrib} AS n_contributors
FROM lineitem"""


@register("anomaly_result", "S10", _anomaly_result_sql())
def q_anomaly_result(spark, sf_dir):
    from telemetra.operators.anomaly import baseline_anomaly_result
    li = cat.table(spark, sf_dir, "lineitem")
    out = baseline_anomaly_result(li, LINEITEM.baselines, threshold=0.7)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
                      rnd("anomaly_score").alias("anomaly_score"), rnd("raw_score").alias("raw_score"),
                      "is_anomaly", F.size("contributing_sensors").cast("long").alias("n_contributors"))


@register("fault_episodes", "W6", """WITH t AS (
  SELECT *, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS f FROM events),
p AS (SELECT *, lag(f, 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pf FROM t)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS episode,
       ts AS start_ts
FROM p WHERE f = 1 AND pf <> 1""")
def q_fault_episodes(spark, sf_dir):
    ev = cat.events_readings(spark, sf_dir).withColumn("fault", EVENTS.fault_col())
    out = FT.fault_episodes(ev, EVENTS.with_(block_rows=16), "fault")
    return out.select("user_id", F.col("episode").cast("long"), "start_ts")


@register("sequences", "W7", """WITH t AS (
  SELECT user_id, ts, event_id, value,
    row_number() OVER w AS rn, count(*) OVER (PARTITION BY user_id) AS cnt,
    sum(value) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS xs,
    count(value) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS xn,
    sum(value) OVER (w ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS ys,
    first_value(value) OVER (w ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS y1
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, rn AS end_rn, ts AS end_ts, xn AS x_len, round(xs, 4) AS x_sum, round(ys, 4) AS y_sum,
       y1 AS y_first
FROM t WHERE rn >= 6 AND rn + 3 <= cnt""")
def q_sequences(spark, sf_dir):
    ev = cat.events_readings(spark, sf_dir)
    out = FT.sequences(ev, EVENTS.with_(block_rows=16), ["value"], ["value"], seq_len=6, horizon=3)
    out = out.drop("seq_idx", "n_seq")
    xs = F.aggregate(F.transform("x", lambda a: a[0]), F.lit(0.0), lambda acc, v: acc + v)
    ys = F.aggregate("y", F.lit(0.0), lambda acc, v: acc + v)
    return out.select("user_id", "end_rn", "end_ts", F.size("x").cast("long").alias("x_len"),
                      F.round(xs, 4).alias("x_sum"), F.round(ys, 4).alias("y_sum"),
                      F.col("y")[0].alias("y_first"))


@register("sequence_split", "W8 W7", """WITH t AS (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
    count(*) OVER (PARTITION BY user_id) AS cnt FROM events)
SELECT user_id, rn AS end_rn, rn - 5 AS seq_idx, cnt - 8 AS n_seq,
  CASE WHEN rn - 5 <= floor((cnt - 8) * 0.8) THEN 'train' ELSE 'validation' END AS split
FROM t WHERE rn >= 6 AND rn + 3 <= cnt""")
def q_sequence_split(spark, sf_dir):
    """The first four fifths of each asset's training sequences train, the rest validate."""
    ev = cat.events_readings(spark, sf_dir)
    seqs = FT.sequences(ev, EVENTS.with_(block_rows=16), ["value"], ["value"], seq_len=6, horizon=3)
    return FT.split_sequences(seqs).select("user_id", "end_rn", "seq_idx", "n_seq", "split")


@register("chronological_split", "W8", """SELECT event_id, user_id,
  CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
            <= floor(count(*) OVER (PARTITION BY user_id) * 0.8) THEN 'train' ELSE 'validation' END AS split
FROM events""")
def q_chronological_split(spark, sf_dir):
    out = FT.chronological_split(cat.events_readings(spark, sf_dir), EVENTS, validation=0.2)
    return out.select("event_id", "user_id", "split")


# ---------------------------------------------------------------------------
# Alerts
# ---------------------------------------------------------------------------

LI_RULES = (
    ("QTY_HIGH", "l_quantity", "threshold_high", 40.0, 48.0, "quantity high", 43200),
    ("DISC_LOW", "l_discount", "threshold_low", 0.02, 0.0, "discount low", 43200),
    ("TAX_SCORE", "l_tax", "anomaly_score", 0.06, 0.08, "tax score", 43200),
    ("PRICE_RATE", "l_extendedprice", "rate_of_change", 80000.0, 100000.0, "price swing", 43200),
    ("OFF", "l_quantity", "threshold_high", 1.0, 2.0, "disabled rule", 15, False),
)


def _li_events(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir)
    long_df = AL.readings_long(li, "l_suppkey", "l_shipdate", S,
                               keep=["l_orderkey", "l_linenumber", "l_partkey"])
    rules = AL.rules_frame(spark, LI_RULES)
    return AL.evaluate_rules(long_df, rules, "l_suppkey", "l_shipdate",
                             keep=["l_orderkey", "l_linenumber", "l_partkey"]), long_df


def _rules_sql():
    vals = ", ".join(
        f"('{r[0]}', '{r[1]}', '{r[2]}', CAST({r[3]} AS DOUBLE), CAST({r[4]} AS DOUBLE), "
        f"{str(r[7] if len(r) > 7 else True).lower()})"
        for r in LI_RULES)
    return f"""rules(rule_id, sensor_name, rule_type, w, c, enabled) AS (VALUES {vals}),
u AS (SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, sensor AS sensor_name, value
      FROM {LI_UNPIVOT}),
m AS (
  SELECT u.*, rules.*,
    CASE WHEN rule_type IN ('threshold_high', 'anomaly_score', 'failure_probability') THEN
           CASE WHEN value >= c THEN 'CRITICAL' WHEN value >= w THEN 'WARNING' END
         WHEN rule_type = 'threshold_low' THEN
           CASE WHEN value <= c THEN 'CRITICAL' WHEN value <= w THEN 'WARNING' END
         WHEN rule_type = 'rate_of_change' THEN
           CASE WHEN abs(value) >= c THEN 'CRITICAL' WHEN abs(value) >= w THEN 'HIGH' END
    END AS severity
  FROM u JOIN rules USING (sensor_name) WHERE enabled),
ev AS (SELECT *, CAST(CASE WHEN severity = 'CRITICAL' THEN c ELSE w END AS DOUBLE) AS threshold
       FROM m WHERE severity IS NOT NULL)"""


@register("evaluate_rules", "J1 R1 R2", f"""WITH {_rules_sql()}
SELECT rule_id, l_suppkey, l_orderkey, l_linenumber, l_partkey, sensor_name, severity, value, threshold
FROM ev""")
def q_evaluate_rules(spark, sf_dir):
    ev, _ = _li_events(spark, sf_dir)
    return ev.select("rule_id", "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
                     "sensor_name", "severity", "value", "threshold")


def _cooldown_sql(key: str, minutes: int, where: str) -> str:
    return f"""WITH RECURSIVE c AS (
  SELECT {key} AS k, ts, event_id, value FROM events WHERE {where}),
chain AS (
  SELECT k, ts, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, event_id) AS rn FROM c) WHERE rn = 1
  UNION ALL
  SELECT n.k, n.ts, n.event_id FROM chain p, LATERAL (
    SELECT k, ts, event_id FROM c WHERE c.k = p.k AND c.ts >= p.ts + INTERVAL {minutes} MINUTE
    ORDER BY ts, event_id LIMIT 1) n)
SELECT k AS {key}, event_id, ts FROM chain"""


def _cooldown_query(spark, sf_dir, key, minutes):
    ev = cat.events_readings(spark, sf_dir).filter(F.col("value") >= 100)
    ev = ev.withColumn("alert_id", F.col("event_id"))
    out = AL.apply_cooldown(ev, "ts", [key], id_col="alert_id", cooldown_col=None,
                            cooldown_minutes=minutes)
    return out.select(key, "event_id", "ts")


@register("cooldown_per_asset", "R3", _cooldown_sql("user_id", 1440, "value >= 100"))
def q_cooldown_per_asset(spark, sf_dir):
    return _cooldown_query(spark, sf_dir, "user_id", 1440)


@register("cooldown_shared", "R3", _cooldown_sql("event_type", 15, "value >= 100"))
def q_cooldown_shared(spark, sf_dir):
    return _cooldown_query(spark, sf_dir, "event_type", 15)


def _derive_sql():
    return """WITH d(alarm_code, sensor_name, op, threshold, alarm_description, severity) AS (VALUES
  ('Q1', 'l_quantity', '>', 48.0, 'Quantity high', 'CRITICAL'),
  ('D1', 'l_discount', '<', 0.01, 'Discount low', 'INFO'),
  ('T1', 'l_tax', '>', 0.07, 'Tax high', 'WARNING')),
u AS (SELECT l_suppkey, l_shipdate, sensor AS sensor_name, value FROM """ + LI_UNPIVOT + """)
SELECT l_shipdate AS timestamp, l_suppkey AS turbine_id, alarm_code, alarm_description, severity,
       value AS sensor_value, CAST(threshold AS DOUBLE) AS threshold
FROM u JOIN d USING (sensor_name)
WHERE (op = '>' AND value > threshold) OR (op = '<' AND value < threshold)"""


LI_ALARMS = {"Q1": ("l_quantity", ">", 48.0), "D1": ("l_discount", "<", 0.01),
             "T1": ("l_tax", ">", 0.07)}
LI_ALARM_CODES = {"Q1": ("Quantity high", "CRITICAL"), "D1": ("Discount low", "INFO"),
                  "T1": ("Tax high", "WARNING")}


@register("derive_alarms", "R8", _derive_sql())
def q_derive_alarms(spark, sf_dir):
    return AL.derive_alarms(cat.lineitem_readings(spark, sf_dir), "l_suppkey", "l_shipdate",
                            LI_ALARMS, LI_ALARM_CODES)


def _fault_alerts_sql():
    zs = [(s, f"abs(({s} - {m}) / {sd})", m) for s, (m, sd) in LINEITEM.baselines.items()]
    # worst = largest z, first listed wins ties
    best = zs[0]
    expr_z = best[1]
    expr_s = f"'{best[0]}'"
    expr_v = best[0]
    expr_m = str(best[2])
    for s, z, m in zs[1:]:
        cond = f"{z} > ({expr_z})"
        expr_s = f"CASE WHEN {cond} THEN '{s}' ELSE {expr_s} END"
        expr_v = f"CASE WHEN {cond} THEN {s} ELSE {expr_v} END"
        expr_m = f"CASE WHEN {cond} THEN {m} ELSE {expr_m} END"
        expr_z = f"greatest({z}, {expr_z})"
    return f"""WITH t AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {", ".join(c + " DESC" for c in LI_ORDER.split(", "))}) AS k
                 FROM lineitem WHERE l_returnflag = 'R') WHERE k <= 20),
w AS (SELECT *, {expr_z} AS z, {expr_s} AS ws, {expr_v} AS wv, {expr_m} AS wm FROM t)
SELECT l_shipdate AS timestamp, l_suppkey AS turbine_id, 'ALM-' || upper(substr(ws, 1, 6)) AS alarm_code,
  ws AS worst_sensor, {sround('z', 4)} AS z, CASE WHEN z > 3 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
  {sround('wv', 2)} AS sensor_value, {sround('wm', 2)} AS threshold
FROM w"""


@register("fault_alerts", "R10", _fault_alerts_sql())
def q_fault_alerts(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir).withColumn("fault", LINEITEM.fault_col())
    return AL.fault_alerts(li, "l_suppkey", "l_shipdate", "fault", LINEITEM.baselines,
                           last_n=20, tiebreak=LINEITEM.tiebreak)


@register("alert_summary", "A9 R11", f"""WITH {_rules_sql()}
SELECT l_suppkey AS turbine_id, count(*) AS total_active,
  count(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
  count(*) FILTER (WHERE severity = 'WARNING') AS warning,
  count(*) FILTER (WHERE severity = 'INFO') AS info,
  min(l_shipdate) AS first_alert, max(l_shipdate) AS last_alert
FROM ev WHERE severity <> 'HIGH' GROUP BY 1""")
def q_alert_summary(spark, sf_dir):
    ev, _ = _li_events(spark, sf_dir)
    ev = ev.withColumnRenamed("l_suppkey", "turbine_id")
    kept = ev.filter(F.col("severity") != "HIGH").withColumn("resolved", F.col("acknowledged"))
    out = AL.alert_summary(AL.filter_alerts(kept, active_only=True), ["turbine_id"], "l_shipdate")
    return out.select("turbine_id", *[F.col(c).cast("long") for c in
                                      ("total_active", "critical", "warning", "info")],
                      "first_alert", "last_alert")


# ---------------------------------------------------------------------------
# Trends: degradation, RUL, failure prediction, forecast
# ---------------------------------------------------------------------------

RUL_ROLES = {"vibration_mm_s": "l_quantity", "exhaust_gas_temp_c": "l_extendedprice",
             "efficiency_pct": "l_discount"}


def _rul_frame(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir)
    base = ST.calibrate(C.only_normal(li, LINEITEM), list(RUL_ROLES.values()), min_rows=100)
    params = TR.baseline_row(base)
    return TR.degradation_index(li, params, roles=RUL_ROLES)


def _rul_sql(keys=("l_suppkey",), having=""):
    kc = ", ".join(keys)
    b = """b AS (SELECT sensor, avg(value) AS m, stddev_samp(value) AS sd FROM """ + LI_UNPIVOT + \
        """ WHERE l_returnflag <> 'R' GROUP BY 1)"""
    def dev(col, rev=False):
        m = f"(SELECT m FROM b WHERE sensor = '{col}')"
        sd = f"(SELECT sd FROM b WHERE sensor = '{col}')"
        d = f"({m} - {col}) / ({sd} + 1e-10)" if rev else f"({col} - {m}) / ({sd} + 1e-10)"
        return f"least(greatest(({d}) / 5.0, 0.0), 1.0)"
    deg = (f"({dev('l_quantity')} * 0.4 + {dev('l_extendedprice')} * 0.35 + "
           f"{dev('l_discount', True)} * 0.25) / 1.0")
    order = LI_ORDER
    return f"""WITH {b},
d AS (SELECT {kc}, {deg} AS y,
        row_number() OVER (PARTITION BY {kc} ORDER BY {order}) AS rn,
        count(*) OVER (PARTITION BY {kc}) AS cnt FROM lineitem),
rec AS (SELECT *, CAST(rn - greatest(cnt - 336, 0) - 1 AS DOUBLE) AS x FROM d WHERE rn > cnt - 336),
a AS (SELECT {kc}, count(*) AS n, regr_count(y, x) AS k, regr_slope(y, x) AS slope,
        regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, arg_max(y, rn) AS cur FROM rec GROUP BY {kc} {having}),
f AS (SELECT *,
  CASE WHEN n < 2 OR k < 2 THEN NULL WHEN slope > 1e-12 THEN
         CASE WHEN 0.7 - cur > 0 THEN (0.7 - cur) / slope / 48 ELSE 0.0 END ELSE 365.0 END AS rul,
  CASE WHEN n < 2 THEN 0.0 WHEN k < 2 THEN cur ELSE least(1.0, exp(cur * 3 - 2)) END AS p,
  CASE WHEN n >= 2 AND k >= 2 THEN 1 - (syy - slope * sxy) / (syy + 1e-10) END AS r2 FROM a)
SELECT {kc}, {r('rul')} AS rul_days, {r('p')} AS failure_probability, {r('cur')} AS degradation_index,
  CASE WHEN r2 > 0.8 THEN 'HIGH' WHEN r2 > 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
  CASE WHEN rul IS NULL THEN NULL
       WHEN rul <= 3 OR p > 0.8 THEN 'IMMEDIATE: Schedule emergency maintenance within 24 hours'
       WHEN rul <= 7 OR p > 0.6 THEN 'URGENT: Plan maintenance within the next 3-5 days'
       WHEN rul <= 14 OR p > 0.4 THEN 'WARNING: Schedule maintenance within 2 weeks'
       WHEN rul <= 30 OR p > 0.2 THEN 'ADVISORY: Monitor closely, plan maintenance in next scheduled window'
       ELSE 'NORMAL: Continue standard monitoring schedule' END AS recommendation
FROM f"""


@register("estimate_rul", "A13 S14 S15 S16 T1", _rul_sql())
def q_estimate_rul(spark, sf_dir):
    deg = _rul_frame(spark, sf_dir)
    out = TR.estimate_rul(deg, LINEITEM, window_days=7, interval_minutes=30, rounded=False)
    return out.select("l_suppkey", rnd("rul_days").alias("rul_days"),
                      rnd("failure_probability").alias("failure_probability"),
                      rnd("degradation_index").alias("degradation_index"), "confidence",
                      "recommendation")


def _failure_sql():
    return f"""WITH d AS (SELECT l_suppkey, l_quantity / 20 AS v, l_extendedprice / 200 AS t,
        CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS f,
        row_number() OVER (PARTITION BY l_suppkey ORDER BY {LI_ORDER}) AS rn,
        count(*) OVER (PARTITION BY l_suppkey) AS cnt FROM lineitem),
rec AS (SELECT *, CAST(rn - greatest(cnt - 400, 0) - 1 AS DOUBLE) AS x FROM d WHERE rn > cnt - 400),
a AS (SELECT l_suppkey, count(*) AS n, coalesce(regr_slope(v, x), 0.0) AS vs, arg_max(v, rn) AS lv,
        arg_max(t, rn) AS lt, avg(f) AS fr FROM rec GROUP BY 1),
g AS (SELECT *, least(1.0, greatest(0.0, (lv - 1.98) / 0.49) * 0.3 + greatest(0.0, (lt - 499.0) / 28.8) * 0.3
                      + fr * 0.4) AS dg FROM a),
h AS (SELECT *, least(1.0, exp(dg * 3 - 2)) AS p,
  CASE WHEN dg < 0.7 AND vs >= 0 THEN least(365.0, greatest(0.0, (0.7 - dg) / greatest(vs * 288, 0.001)))
       WHEN dg >= 0.7 THEN greatest(0.0, (1.0 - dg) * 10) ELSE 180.0 END AS days FROM g)
SELECT l_suppkey, n >= 12 AS sufficient_data, {r('p')} AS failure_probability, {r('days')} AS rul_days,
  {r('dg')} AS degradation_index,
  CASE WHEN p > 0.8 OR days < 3 THEN 'CRITICAL' WHEN p > 0.6 OR days < 7 THEN 'HIGH'
       WHEN p > 0.3 OR days < 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  CASE WHEN days <= 3 THEN 'IMMEDIATE: Schedule emergency maintenance within 24 hours'
       WHEN days <= 7 THEN 'URGENT: Plan maintenance within the next 3-5 days'
       WHEN days <= 14 THEN 'WARNING: Schedule maintenance within 2 weeks'
       WHEN days <= 30 THEN 'ADVISORY: Monitor closely, plan maintenance in next window'
       ELSE 'NORMAL: Continue standard monitoring schedule' END AS recommendation
FROM h"""


@register("failure_prediction", "T3 S15 S16 S17", _failure_sql())
def q_failure_prediction(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir).withColumns({
        "_vib": F.col("l_quantity") / 20, "_egt": F.col("l_extendedprice") / 200})
    out = TR.failure_prediction(li, LINEITEM, "_vib", "_egt", window_rows=400, rounded=False)
    return out.select("l_suppkey", "sufficient_data", rnd("failure_probability").alias("failure_probability"),
                      rnd("rul_days").alias("rul_days"), rnd("degradation_index").alias("degradation_index"),
                      "risk_level", "recommendation")


def _forecast_sql():
    return f"""WITH d AS (SELECT user_id, ts, value,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
        count(*) OVER (PARTITION BY user_id) AS cnt FROM events),
l AS (SELECT *, CAST(rn - greatest(cnt - 12, 0) - 1 AS DOUBLE) AS x FROM d WHERE rn > cnt - 12),
fit AS (SELECT user_id, count(*) AS k, regr_slope(value, x) AS b, regr_intercept(value, x) AS a,
          max(ts) AS last_ts FROM l GROUP BY 1 HAVING count(*) >= 2),
s AS (SELECT *, unnest(range(1, 13)) AS step FROM fit)
SELECT user_id, 'value' AS sensor, step, {r('a + b * (k - 1 + step)')} AS value,
  last_ts + step * INTERVAL 5 MINUTE AS forecast_ts,
  {r('(a + b * (k - 1 + step)) * 0.97')} AS lower_bound, {r('(a + b * (k - 1 + step)) * 1.03')} AS upper_bound
FROM s WHERE step <= 12"""


@register("linear_forecast", "T4 T5", _forecast_sql())
def q_linear_forecast(spark, sf_dir):
    ev = cat.events_readings(spark, sf_dir)
    fc = TR.linear_forecast(ev, EVENTS, ["value"], fit_rows=12, steps=12)
    last = ev.groupBy("user_id").agg(F.max("ts").alias("last_ts"))
    fc = fc.join(last, "user_id")
    out = TR.forecast_bands(fc, "last_ts", horizon_minutes=60, step_minutes=5)
    return out.select("user_id", "sensor", F.col("step").cast("long"), rnd("value").alias("value"),
                      F.col("forecast_ts").cast("timestamp_ntz").alias("forecast_ts"),
                      rnd("lower_bound").alias("lower_bound"), rnd("upper_bound").alias("upper_bound"))


# ---------------------------------------------------------------------------
# Drift
# ---------------------------------------------------------------------------

DRIFT_SPLIT_LI = "1996-01-01"


def _drift_sql():
    import math
    big = " + ".join(
        f"{(-1) ** (k - 1)} * exp(-2.0 * {k * k} * lam * lam)" for k in range(1, DR.KS_TERMS + 1))
    small = " + ".join(
        f"exp(-{(2 * k - 1) ** 2} * {math.pi ** 2!r} / (8.0 * lam * lam))"
        for k in range(1, DR.KS_TERMS + 1))
    ks_expr = (f"CASE WHEN lam < 1.18 THEN 1.0 - {math.sqrt(2 * math.pi)!r} / lam * ({small}) "
               f"ELSE 2 * ({big}) END")
    return f"""WITH u AS (SELECT sensor AS feature, value, l_shipdate < TIMESTAMP '{DRIFT_SPLIT_LI}' AS is_base
                FROM {LI_UNPIVOT} WHERE value IS NOT NULL),
n AS (SELECT feature, count(*) FILTER (WHERE is_base) AS nb, count(*) FILTER (WHERE NOT is_base) AS nc,
        min(value) AS lo, max(value) AS hi,
        avg(value) FILTER (WHERE is_base) AS bm, stddev_samp(value) FILTER (WHERE is_base) AS bsd,
        avg(value) FILTER (WHERE NOT is_base) AS cm FROM u GROUP BY 1),
v AS (SELECT feature, value, sum(CASE WHEN is_base THEN 1 ELSE 0 END) AS cb,
        sum(CASE WHEN is_base THEN 0 ELSE 1 END) AS cc FROM u GROUP BY 1, 2),
cum AS (SELECT v.feature, sum(cb) OVER w AS scb, sum(cc) OVER w AS scc FROM v
        WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT cum.feature, max(abs(scb / nb - scc / nc)) AS d FROM cum JOIN n USING (feature) GROUP BY 1),
bins AS (SELECT u.feature, CASE WHEN hi > lo THEN least(floor((value - lo) / (hi - lo) * 10), 9) END AS bin,
           sum(CASE WHEN is_base THEN 1 ELSE 0 END) AS cb, sum(CASE WHEN is_base THEN 0 ELSE 1 END) AS cc
         FROM u JOIN n USING (feature) GROUP BY 1, 2),
psi AS (SELECT bins.feature, sum(CASE WHEN bin IS NULL THEN 0.0 ELSE
          (greatest(cc / nc, 1e-6) - greatest(cb / nb, 1e-6)) * ln(greatest(cc / nc, 1e-6) / greatest(cb / nb, 1e-6)) END) AS psi
        FROM bins JOIN n USING (feature) GROUP BY 1),
r AS (SELECT feature, d, psi, nb, nc, bm, bsd, cm, sqrt(nb * nc / (nb + nc)) * d AS lam
      FROM ks JOIN psi USING (feature) JOIN n USING (feature) WHERE nc >= 10),
p AS (SELECT *, CASE WHEN lam <= 0 THEN 1.0 ELSE least(greatest({ks_expr}, 0.0), 1.0) END AS pv FROM r),
q AS (SELECT *, pv < 0.05 OR psi > 0.2 AS drifted FROM p)
SELECT feature, {r('d')} AS ks_statistic, {r('pv')} AS p_value, {r('psi')} AS psi,
  {r('abs(cm - bm) / (bsd + 1e-10)')} AS mean_shift_sigma, drifted AS is_drifted,
  count(*) OVER () AS total_features, count(*) FILTER (WHERE drifted) OVER () AS drift_count,
  CASE WHEN count(*) FILTER (WHERE drifted) OVER () > 0 THEN 'DRIFT_DETECTED' ELSE 'STABLE' END AS overall_status
FROM q"""


@register("drift_report", "D1 D2 D3 D4", _drift_sql())
def q_drift_report(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir)
    split = F.lit(DRIFT_SPLIT_LI).cast("timestamp_ntz")
    rep = DR.drift_report(li.filter(F.col("l_shipdate") < split),
                          li.filter(F.col("l_shipdate") >= split), S)
    return rep.select("feature", rnd("ks_statistic").alias("ks_statistic"),
                      rnd("p_value").alias("p_value"), rnd("psi").alias("psi"),
                      rnd("mean_shift_sigma").alias("mean_shift_sigma"), "is_drifted",
                      F.col("total_features").cast("long"), F.col("drift_count").cast("long"),
                      "overall_status")


@register("drift_history", "D5", """WITH checks AS (
  SELECT date_trunc('day', ts) AS checked_at,
         CASE WHEN avg(value) > 50 THEN 'DRIFT_DETECTED' ELSE 'STABLE' END AS overall_status
  FROM events GROUP BY 1)
SELECT count(*) AS total_checks, max(checked_at) AS last_check,
  count(*) FILTER (WHERE overall_status = 'DRIFT_DETECTED') AS drift_detected_count,
  CASE WHEN count(*) = 0 THEN 'NO_CHECKS_RUN' ELSE arg_max(overall_status, checked_at) END AS latest_status
FROM checks""")
def q_drift_history(spark, sf_dir):
    from telemetra.operators.kpi import time_bucket
    ev = cat.events_readings(spark, sf_dir)
    checks = ev.groupBy(time_bucket("ts", "day").alias("checked_at")).agg(
        F.when(F.avg("value") > 50, "DRIFT_DETECTED").otherwise("STABLE").alias("overall_status"))
    out = DR.drift_history_summary(checks)
    return out.select(F.col("total_checks").cast("long"), "last_check",
                      F.col("drift_detected_count").cast("long"), "latest_status")
