"""Registered queries: reports (P1-P7), anomaly model (M1-M4), S11, S13,
imputation (C9/C10), synthetic clock (IO5), inventory (IO12), RUL per
fault type (T2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.functions import scoring as SC
from telemetra.operators import anomaly as AN
from telemetra.operators import clean as C
from telemetra.operators import features as FT
from telemetra.operators import kpi as K
from telemetra.operators import stats as ST
from telemetra.operators import trend as TR
from telemetra.plans import catalog as cat
from telemetra.plans import reports as RP
from telemetra.plans.catalog import EVENTS, LINEITEM, LINEITEM_HEALTH, LINEITEM_SENSORS
from telemetra.plans.queries_core import rnd
from telemetra.plans.queries_more import (CORR_PAIRS, LI_ORDER, LI_UNPIVOT, RUL_ROLES,
                                          _corr_sql, _rul_frame)
from telemetra.plans.registry import register
from telemetra.plans.sqlgen import lineitem_clean_ctes, r, sround, zscore_cte
from telemetra.sources.readers import assign_timestamps

S = LINEITEM_SENSORS
LI_DESC = ", ".join(f"{c} DESC" for c in LI_ORDER.split(", "))


def _z_sql(s):
    m, sd = LINEITEM.baselines[s]
    return f"abs(({s} - {m}) / {sd})"


LI_HEALTH_SQL = ("least(greatest(100 - (" + " + ".join(
    f"CASE WHEN {_z_sql(s)} > 3 THEN 25 WHEN {_z_sql(s)} > 2 THEN 10 WHEN {_z_sql(s)} > 1.5 "
    f"THEN 3 ELSE 0 END" for s in S) + " + CASE WHEN l_returnflag = 'R' THEN 30 ELSE 0 END), 0.0), 100.0)")
LI_ANOM_SQL = "least(greatest((" + " + ".join(_z_sql(s) for s in S) + f") / {len(S)} / 5.0, 0.0), 1.0)"


def _li_scored(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir)
    return li.withColumns({
        "health_score": SC.baseline_health(LINEITEM.baselines, fault=LINEITEM.fault_col()),
        "anomaly_score": SC.baseline_anomaly(LINEITEM.baselines),
        "fault": LINEITEM.fault_col()})


def _fault_rank_sql(src: str) -> str:
    return f"""u AS (SELECT l_suppkey, sensor, value, f = 1 AS ff FROM (UNPIVOT {src} ON l_quantity,
      l_extendedprice, l_discount, l_tax INTO NAME sensor VALUE value)),
g AS (SELECT l_suppkey, sensor,
    CASE WHEN count(*) FILTER (WHERE ff) > 0 THEN avg(value) FILTER (WHERE ff) ELSE 0.0 END AS fm,
    CASE WHEN count(*) FILTER (WHERE NOT ff) > 0 THEN avg(value) FILTER (WHERE NOT ff) ELSE 0.0 END AS nm,
    CASE WHEN count(*) FILTER (WHERE NOT ff) > 1 THEN stddev_samp(value) FILTER (WHERE NOT ff) ELSE 1.0 END AS ns
  FROM u GROUP BY 1, 2),
z AS (SELECT *, abs(fm - nm) / greatest(ns, 0.001) AS zd FROM g),
rk AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY zd DESC, sensor) AS rank FROM z)"""


@register("health_report", "P1 S8 A6 A7", f"""WITH t AS (
  SELECT *, {LI_HEALTH_SQL} AS h, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS f,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY {LI_DESC}) AS k FROM lineitem),
l AS (SELECT * FROM t WHERE k <= 100),
st AS (SELECT l_suppkey, round(avg(h), 4) AS a, round(min(h), 4) AS mn, count(*) AS n,
         sum(f) AS fc FROM l GROUP BY 1),
{_fault_rank_sql('l')},
top AS (SELECT l_suppkey, max(CASE WHEN rank = 1 THEN sensor END) AS top_sensor_1,
          max(CASE WHEN rank = 2 THEN sensor END) AS top_sensor_2,
          max(CASE WHEN rank = 3 THEN sensor END) AS top_sensor_3 FROM rk GROUP BY 1),
x AS (SELECT st.*, round(fc / greatest(n, 1), 4) AS fault_rate, top_sensor_1, top_sensor_2,
        top_sensor_3 FROM st LEFT JOIN top USING (l_suppkey)),
y AS (SELECT *, CASE WHEN a >= 85 AND fault_rate < 0.1 THEN 'LOW'
                     WHEN a >= 65 AND fault_rate < 0.3 THEN 'MEDIUM' WHEN a >= 40 THEN 'HIGH'
                     ELSE 'CRITICAL' END AS risk_level FROM x)
SELECT l_suppkey, {sround('a', 1)} AS avg_health, {sround('mn', 1)} AS min_health, fault_rate,
  fc AS fault_count, risk_level,
  CASE risk_level WHEN 'LOW' THEN 'HEALTHY' WHEN 'MEDIUM' THEN 'DEGRADED' WHEN 'HIGH' THEN 'AT RISK'
       ELSE 'CRITICAL' END AS status, top_sensor_1, top_sensor_2, top_sensor_3
FROM y""")
def q_health_report(spark, sf_dir):
    return RP.health_report(_li_scored(spark, sf_dir), LINEITEM, last_n=100)


def _anom_report_sql():
    zs = " UNION ALL ".join(
        f"SELECT l_suppkey, '{s}' AS sensor, {_z_sql(s)} AS z FROM l" for s in S)
    return f"""WITH t AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {LI_DESC}) AS k
               FROM lineitem),
l AS (SELECT * FROM t WHERE k <= 200),
z AS ({zs}),
c AS (SELECT l_suppkey, sensor, count(*) FILTER (WHERE z > 2.5) AS total_anomalies FROM z GROUP BY 1, 2),
d AS (SELECT *, round(total_anomalies / 200, 4) AS anomaly_rate FROM c)
SELECT l_suppkey, sensor, total_anomalies, anomaly_rate,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY anomaly_rate DESC, sensor) AS rank,
  CASE WHEN max(anomaly_rate) OVER (PARTITION BY l_suppkey) > 0.3 THEN 'CRITICAL'
       WHEN max(anomaly_rate) OVER (PARTITION BY l_suppkey) > 0.15 THEN 'HIGH'
       WHEN max(anomaly_rate) OVER (PARTITION BY l_suppkey) > 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM d"""


@register("anomaly_report", "P2 S11", _anom_report_sql())
def q_anomaly_report(spark, sf_dir):
    return RP.anomaly_report(cat.lineitem_readings(spark, sf_dir), LINEITEM, S,
                             LINEITEM.baselines, last_n=200)


@register("root_cause_report", "P3 A7 A8", f"""WITH l AS (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS f FROM lineitem),
{_fault_rank_sql('l')},
cr AS (SELECT l_suppkey, sensor, corr(value, CASE WHEN ff THEN 1.0 ELSE 0.0 END) AS rr FROM u GROUP BY 1, 2),
cr2 AS (SELECT *, coalesce(rr, 0.0) AS pearson_r,
   CASE WHEN rr IS NULL OR isnan(rr) THEN NULL WHEN rr > 0.7 THEN 'strong positive'
        WHEN rr > 0.3 THEN 'moderate positive' WHEN rr > -0.3 THEN 'weak/no'
        WHEN rr > -0.7 THEN 'moderate negative' ELSE 'strong negative' END AS interpretation FROM cr),
cr3 AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY abs(pearson_r) DESC, sensor) AS corr_rank FROM cr2),
fr AS (SELECT l_suppkey, round(sum(f) / greatest(count(*), 1), 4) AS fault_rate FROM l GROUP BY 1)
SELECT rk.l_suppkey, rk.sensor, {r(sround('zd', 4))} AS z_difference, zd > 1.5 AS significant, rank,
  {r('pearson_r')} AS pearson_r, interpretation, corr_rank, fault_rate,
  CASE WHEN fault_rate > 0.2 THEN 'HIGH' WHEN fault_rate > 0.1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM rk JOIN cr3 USING (l_suppkey, sensor) JOIN fr USING (l_suppkey)""")
def q_root_cause_report(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir)
    out = RP.root_cause_report(li, LINEITEM, S)
    return out.withColumns({"z_difference": rnd("z_difference"), "pearson_r": rnd("pearson_r")})


@register("correlation_report", "P4 A8", f"""WITH c AS ({_corr_sql(raw=True)})
SELECT l_suppkey, sensor_a, sensor_b, {r('pearson_r')} AS pearson_r, interpretation, abs(pearson_r) > 0.5 AS strong,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY abs(pearson_r) DESC, sensor_a, sensor_b) AS rank,
  'LOW' AS risk_level
FROM c""")
def q_correlation_report(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir)
    out = RP.correlation_report(li, CORR_PAIRS, group_cols=["l_suppkey"])
    return out.withColumn("pearson_r", rnd("pearson_r"))


LI_LIMITS = {"l_quantity": (40.0, 48.0, "high"), "l_tax": (0.07, 0.08, "high"),
             "l_discount": (0.02, 0.0, "low")}


def _sensor_report_sql():
    return f"""WITH t AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {LI_DESC}) AS k FROM lineitem),
l AS (SELECT * FROM t WHERE k <= 50),
u AS (SELECT l_suppkey, sensor, value FROM (UNPIVOT l ON l_quantity, l_extendedprice, l_discount, l_tax
      INTO NAME sensor VALUE value)),
s AS (SELECT l_suppkey, sensor, {sround('avg(value)', 4)} AS mean, {sround('stddev_samp(value)', 4)} AS std,
        {sround('min(value)', 4)} AS min, {sround('max(value)', 4)} AS max,
        {sround('quantile_cont(value, 0.25)', 4)} AS p25, {sround('quantile_cont(value, 0.5)', 4)} AS p50,
        {sround('quantile_cont(value, 0.75)', 4)} AS p75, count(value) AS count FROM u GROUP BY 1, 2),
x AS (SELECT *, coalesce(max > CASE sensor WHEN 'l_quantity' THEN 40.0 WHEN 'l_tax' THEN 0.07 END, false) AS above_warning,
        coalesce(max > CASE sensor WHEN 'l_quantity' THEN 48.0 WHEN 'l_tax' THEN 0.08 END, false) AS above_critical FROM s)
SELECT *, CASE WHEN bool_or(above_critical) OVER (PARTITION BY l_suppkey) THEN 'HIGH'
               WHEN bool_or(above_warning) OVER (PARTITION BY l_suppkey) THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM x"""


@register("sensor_report", "P5 J4 A6", _sensor_report_sql())
def q_sensor_report(spark, sf_dir):
    return RP.sensor_report(cat.lineitem_readings(spark, sf_dir), LINEITEM, LI_LIMITS, last_n=50)


_EV_Z = "abs((value - 50.0) / 50.0)"


@register("diagnose_trigger", "P6 S8 S9", f"""WITH t AS (
  SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fault,
    least(greatest(100 - (CASE WHEN {_EV_Z} > 3 THEN 25 WHEN {_EV_Z} > 2 THEN 10 WHEN {_EV_Z} > 1.5 THEN 3
      ELSE 0 END + CASE WHEN event_type = 'error' THEN 30 ELSE 0 END), 0.0), 100.0) AS health_score,
    least(greatest({_EV_Z} / 5.0, 0.0), 1.0) AS anomaly_score FROM events)
SELECT event_id, user_id, CASE WHEN fault = 1 THEN 'FAULT' WHEN anomaly_score >= 0.6 THEN 'ANOMALY'
  ELSE 'DEGRADED' END AS alert_type, CASE WHEN fault = 1 THEN 'CRITICAL' ELSE 'HIGH' END AS risk_level
FROM t WHERE fault = 1 OR anomaly_score >= 0.6 OR health_score <= 60""")
def q_diagnose_trigger(spark, sf_dir):
    ev = cat.events_readings(spark, sf_dir).withColumns({
        "fault": EVENTS.fault_col(),
        "health_score": SC.baseline_health(EVENTS.baselines, fault=EVENTS.fault_col()),
        "anomaly_score": SC.baseline_anomaly(EVENTS.baselines)})
    return RP.diagnose_trigger(ev).select("event_id", "user_id", "alert_type", "risk_level")


def _gates_sql():
    feat_cols = 10 + 2 * len(S) + 2  # readings + z/flag per sensor + score + is_anomaly
    return f"""WITH raw AS (SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax,
                        l_returnflag, l_orderkey, l_linenumber, l_partkey FROM lineitem),
r AS (SELECT count(*) AS n, count(DISTINCT (l_suppkey, l_shipdate)) AS keys,
        count(*) FILTER (WHERE l_suppkey IS NULL) + count(*) FILTER (WHERE l_shipdate IS NULL)
        + count(*) FILTER (WHERE l_quantity IS NULL) + count(*) FILTER (WHERE l_extendedprice IS NULL)
        + count(*) FILTER (WHERE l_discount IS NULL) + count(*) FILTER (WHERE l_tax IS NULL)
        + count(*) FILTER (WHERE l_returnflag IS NULL) + count(*) FILTER (WHERE l_orderkey IS NULL)
        + count(*) FILTER (WHERE l_linenumber IS NULL) + count(*) FILTER (WHERE l_partkey IS NULL) AS nulls
      FROM raw),
{lineitem_clean_ctes()},
{zscore_cte('clean', 'silver', 'l_suppkey', 'l_shipdate', S)},
s AS (SELECT avg(CASE WHEN is_anomaly THEN 1.0 ELSE 0.0 END) AS ar,
        count(*) FILTER (WHERE NOT (coalesce(l_quantity BETWEEN 1.0 AND 45.0, true)
          AND coalesce(l_extendedprice BETWEEN 0.0 AND 95000.0, true)
          AND coalesce(l_discount BETWEEN 0.0 AND 0.09, true) AND coalesce(l_tax BETWEEN 0.0 AND 0.08, true))) AS oor
      FROM silver)
SELECT 'bronze' AS tier, 'null_percentage' AS gate, nulls * 100.0 / greatest(n * 10, 1) AS value, 5.0 AS limit,
       nulls * 100.0 / greatest(n * 10, 1) <= 5.0 AS passed FROM r
UNION ALL SELECT 'bronze', 'duplicate_percentage', (n - keys) * 100.0 / greatest(n, 1), 1.0,
       (n - keys) * 100.0 / greatest(n, 1) <= 1.0 FROM r
UNION ALL SELECT 'bronze', 'records', CAST(n AS DOUBLE), 100.0, n >= 100 FROM r
UNION ALL SELECT 'silver', 'anomaly_rate', coalesce(ar, 0.0) * 100, 15.0, coalesce(ar, 0.0) * 100 <= 15.0 FROM s
UNION ALL SELECT 'silver', 'feature_count', {float(feat_cols)}, 50.0, {feat_cols} >= 50
UNION ALL SELECT 'silver', 'out_of_range_rows', CAST(oor AS DOUBLE), 0.0, oor <= 0 FROM s
UNION ALL SELECT 'gold', 'assets', CAST(count(DISTINCT l_suppkey) AS DOUBLE), 1.0, count(DISTINCT l_suppkey) >= 1 FROM silver
UNION ALL SELECT 'gold', 'health_out_of_range', 0.0, 0.0, true
UNION ALL SELECT 'gold', 'missing_tables', 0.0, 0.0, true"""


@register("quality_gates", "P7 A3 A4", _gates_sql())
def q_quality_gates(spark, sf_dir):
    raw = cat.lineitem_readings(spark, sf_dir)
    clean = C.clean_readings(raw, LINEITEM, keep_sequence=True)
    feats = FT.zscore_flags(clean, LINEITEM, lookback=288)
    kpis = K.with_health(K.hourly_kpis(feats, LINEITEM, grain="month", bucket_col="month_bucket"), **LINEITEM_HEALTH)
    out = RP.quality_gates(raw, feats, kpis, LINEITEM, present_tables=(
        "gold_turbine_hourly_kpis", "gold_turbine_latest_status", "gold_alert_history"))
    return out.select("tier", "gate", "value", "limit", "passed")


# ---------------------------------------------------------------------------
# Anomaly model and scores
# ---------------------------------------------------------------------------

@register("iforest_scores", "M1 M2", None)
def q_iforest_scores(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir)
    model = AN.train_iforest(li, S, n_trees=100, max_samples=256, contamination=0.05, seed=42,
                             key_cols=["l_orderkey", "l_linenumber"])
    scored = AN.score_iforest(li, model, normalise="batch")
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "is_anomaly",
                         rnd("anomaly_score").alias("anomaly_score"))


@register("iforest_checks", "M1 M2 M4", """SELECT 'flagged share' AS what, count(*) > 0 AS passed FROM lineitem
UNION ALL SELECT 'planted copies', count(*) > 0 FROM lineitem""")
def q_iforest_checks(spark, sf_dir):
    """What a forest must do whatever its draws: flag the share asked for (5 %, give or take 1.5) and put a copy of
    every row that lies eight standard deviations off in each reading before the rows themselves (AUC over 0.95)."""
    li = cat.lineitem_readings(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", *S)
    model = AN.train_iforest(li, S, n_trees=100, max_samples=256, contamination=0.05, seed=42,
                             key_cols=["l_orderkey", "l_linenumber", "l_partkey"])
    off = li.withColumns({s: F.col(s) + 8.0 * sd for s, sd in zip(S, model.stds)})
    both = li.withColumn("planted", F.lit(0)).union(off.withColumn("planted", F.lit(1)))
    rows = F.count(F.lit(1)).alias("rows")
    flagged = F.count_if(F.col("is_anomaly"))
    share = AN.score_iforest(li, model, normalise=None).agg(rows, flagged.alias("flagged")).select(
        F.lit("flagged share").alias("what"),
        F.col("flagged").between(0.035 * F.col("rows"), 0.065 * F.col("rows")).alias("passed"))
    scored = AN.score_iforest(both, model, normalise=None).withColumn("s", -F.col("score_samples"))
    found = AN.evaluate_anomaly(scored, "planted", "is_anomaly", "s").select(
        F.lit("planted copies").alias("what"), (F.col("auc_roc") > 0.95).alias("passed"))
    return share.union(found)


def _s10_sql_parts():
    zs = [_z_sql(s) for s in S]
    avg = "(" + " + ".join(zs) + f") / {len(zs)}"
    return avg, f"least(1.0, {avg} / 5.0)"


@register("score_summary", "M3 S10", f"""WITH t AS (SELECT {_s10_sql_parts()[1]} AS s FROM lineitem)
SELECT count(*) AS total_records, count(*) FILTER (WHERE s > 0.7) AS anomalies_detected,
  {r('max(s)')} AS max_anomaly_score, {r('avg(s)')} AS mean_anomaly_score FROM t""")
def q_score_summary(spark, sf_dir):
    li = cat.table(spark, sf_dir, "lineitem")
    scored = AN.baseline_anomaly_result(li, LINEITEM.baselines, threshold=0.7)
    out = AN.score_summary(scored)
    return out.select(F.col("total_records").cast("long"), F.col("anomalies_detected").cast("long"),
                      rnd("max_anomaly_score").alias("max_anomaly_score"),
                      rnd("mean_anomaly_score").alias("mean_anomaly_score"))


@register("anomaly_eval", "M4", f"""WITH t AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, {LI_ANOM_SQL} AS s FROM lineitem),
p AS (SELECT *, CASE WHEN s > 0.2 THEN 1 ELSE 0 END AS p FROM t),
b AS (SELECT count(*) AS n, avg(p) AS anomaly_rate, avg(s) AS mean_score, stddev_pop(s) AS std_score,
        sum(y * p) AS tp, sum((1 - y) * p) AS fp, sum(y * (1 - p)) AS fn, sum(y) AS pos, sum(1 - y) AS neg FROM p),
v AS (SELECT s, sum(y) AS wp, sum(1 - y) AS wn FROM p GROUP BY 1),
c AS (SELECT wp, wn, sum(wn) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cwn FROM v),
u AS (SELECT sum(wp * (cwn - wn) + 0.5 * wp * wn) AS u FROM c),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS pr,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc FROM b, u)
SELECT {r('anomaly_rate')} AS anomaly_rate, {r('mean_score')} AS mean_score, {r('std_score')} AS std_score,
  {r('pr')} AS precision, {r('rc')} AS recall,
  {r('CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END')} AS f1_score,
  {r('CASE WHEN pos > 0 AND neg > 0 THEN u / (pos * neg) ELSE 0.0 END')} AS auc_roc
FROM m""")
def q_anomaly_eval(spark, sf_dir):
    li = _li_scored(spark, sf_dir).withColumn("_flag", F.col("anomaly_score") > 0.2)
    out = AN.evaluate_anomaly(li, "fault", "_flag", "anomaly_score")
    return out.select(*[rnd(c).alias(c) for c in out.columns])


@register("contributor_shares", "S13 S10", """WITH z AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_suppkey, 0 AS pos, 'l_quantity' AS sensor,
         abs((l_quantity - 25.5) / 14.4) AS z FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_suppkey, 1, 'l_extendedprice',
         abs((l_extendedprice - 38000.0) / 23000.0) FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_suppkey, 2, 'l_discount',
         abs((l_discount - 0.05) / 0.032) FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_suppkey, 3, 'l_tax',
         abs((l_tax - 0.04) / 0.026) FROM lineitem),
c AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_shipdate, l_suppkey
                                   ORDER BY pos) - 1 AS rank FROM z WHERE z > 1.2)
SELECT l_orderkey, l_linenumber, l_partkey, rank, sensor AS contributor,
       greatest(0.05, 1.0 / (rank + 1)) AS share FROM c""")
def q_contributor_shares(spark, sf_dir):
    li = cat.table(spark, sf_dir, "lineitem")
    scored = AN.baseline_anomaly_result(li, LINEITEM.baselines, contributor_z=1.2)
    out = AN.contributor_shares(scored)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("rank").cast("long"),
                      "contributor", "share")


# ---------------------------------------------------------------------------
# Imputation, synthetic clock, inventory, RUL per fault type
# ---------------------------------------------------------------------------

@register("impute_median", "C3 C9 C10", """WITH t AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_quantity BETWEEN 1.0 AND 45.0 THEN l_quantity END AS q,
    CASE WHEN l_discount BETWEEN 0.0 AND 0.09 THEN l_discount END AS d FROM lineitem),
m AS (SELECT quantile_cont(q, 0.5) AS mq, quantile_cont(d, 0.5) AS md FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(q, mq) AS l_quantity, coalesce(d, md) AS l_discount,
       coalesce(q, 0.0) AS l_quantity_zero
FROM t, m""")
def q_impute_median(spark, sf_dir):
    li = C.null_out_of_range(cat.lineitem_readings(spark, sf_dir), LINEITEM.limits)
    li = li.withColumn("l_quantity_zero", F.col("l_quantity"))
    out = C.impute(li, ["l_quantity", "l_discount"], strategy="median")
    out = C.impute(out, ["l_quantity_zero"], strategy="zero")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount",
                      "l_quantity_zero")


@register("assign_timestamps", "IO5", """SELECT o_orderkey,
  TIMESTAMP '2024-06-30 12:00:00' - to_minutes(CAST(count(*) OVER () - row_number() OVER (ORDER BY o_orderkey) AS BIGINT)) AS timestamp
FROM orders""")
def q_assign_timestamps(spark, sf_dir):
    o = cat.table(spark, sf_dir, "orders").select("o_orderkey")
    out = assign_timestamps(o, ["o_orderkey"], "2024-06-30 12:00:00", step_seconds=60)
    return out.select("o_orderkey", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


@register("table_inventory", "IO12", """SELECT 'lineitem' AS "table", count(*) AS rows, 11 AS columns FROM lineitem
UNION ALL SELECT 'orders', count(*), 6 FROM orders
UNION ALL SELECT 'events', count(*), 6 FROM events
UNION ALL SELECT 'part', count(*), 6 FROM part""")
def q_table_inventory(spark, sf_dir):
    tabs = {n: cat.table(spark, sf_dir, n) for n in ("lineitem", "orders", "events", "part")}
    out = K.table_inventory(tabs)
    return out.select("table", F.col("rows").cast("long"), F.col("columns").cast("int"))


def _rul_fault_sql():
    from telemetra.plans.queries_more import _rul_sql
    return _rul_sql(keys=("l_suppkey", "l_returnflag"), having="HAVING count(*) > 100")


@register("rul_by_fault_type", "T2 T1", _rul_fault_sql())
def q_rul_by_fault_type(spark, sf_dir):
    deg = _rul_frame(spark, sf_dir)
    counts = deg.groupBy("l_suppkey", "l_returnflag").count().filter(F.col("count") > 100)
    deg = deg.join(counts.drop("count"), ["l_suppkey", "l_returnflag"], "left_semi")
    out = TR.estimate_rul(deg, LINEITEM, window_days=7, interval_minutes=30,
                          group_cols=["l_returnflag"], rounded=False)
    return out.select("l_suppkey", "l_returnflag", rnd("rul_days").alias("rul_days"),
                      rnd("failure_probability").alias("failure_probability"),
                      rnd("degradation_index").alias("degradation_index"), "confidence",
                      "recommendation")


# ---------------------------------------------------------------------------
# IO11/J2 retention window, C7/C8/C12 training set, R6/J6 log, R9 payload
# ---------------------------------------------------------------------------

AS_OF = "2024-01-31 00:00:00"


@register("recent_window", "IO11 J2", f"""SELECT event_id, user_id, ts FROM events
WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR AND ts <= TIMESTAMP '{AS_OF}'""")
def q_recent_window(spark, sf_dir):
    from telemetra.operators.lastn import last_hours
    from telemetra.sources.readers import apply_retention
    ev = cat.events_readings(spark, sf_dir)
    kept = apply_retention(ev, "ts", days=90, as_of=AS_OF)
    out = last_hours(kept, EVENTS, 168, AS_OF)
    return out.select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@register("training_set", "C7 C8 C12", """SELECT l_shipdate, l_suppkey, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_faulty FROM lineitem""")
def q_training_set(spark, sf_dir):
    li = cat.lineitem_readings(spark, sf_dir)
    # two sources (returned / other lines) stacked by name, then projected
    parts = [li.filter(F.col("l_returnflag") == "R"), li.filter(F.col("l_returnflag") != "R")]
    proj = C.training_projection(C.union_sources(parts), LINEITEM)
    return C.with_fault_label(proj, "l_returnflag = 'R'")


def _alert_id_sql():
    return "sha256(concat_ws('|', CAST(l_suppkey AS VARCHAR), rule_id, CAST(l_shipdate AS VARCHAR)))"


def _alert_log_sql():
    from telemetra.plans.queries_more import _rules_sql
    return f"""WITH {_rules_sql()},
e AS (SELECT {_alert_id_sql()} AS alert_id, rule_id, l_suppkey, severity, l_shipdate FROM ev)
SELECT * FROM e ORDER BY l_shipdate DESC, alert_id DESC LIMIT 100"""


@register("alert_log", "R6 J6 R2", _alert_log_sql())
def q_alert_log(spark, sf_dir):
    from telemetra.plans.queries_more import _li_events
    ev, _ = _li_events(spark, sf_dir)
    from telemetra.operators import alerts as AL
    return AL.alert_log(ev, "l_shipdate", 100).select("alert_id", "rule_id", "l_suppkey",
                                                      "severity", "l_shipdate")


def _payload_sql():
    from telemetra.plans.queries_more import _rules_sql
    colour = ("CASE severity WHEN 'INFO' THEN '0078D4' WHEN 'WARNING' THEN 'FFC107' "
              "WHEN 'HIGH' THEN 'FF8C00' WHEN 'CRITICAL' THEN 'D13438' ELSE '888888' END")
    emph = "CASE WHEN severity IN ('HIGH', 'CRITICAL') THEN 'Attention' ELSE 'Default' END"
    desc = "CASE rule_id " + " ".join(
        f"WHEN '{r[0]}' THEN '{r[5]}'" for r in __import__(
            "telemetra.plans.queries_more", fromlist=["LI_RULES"]).LI_RULES) + " END"
    return f"""WITH {_rules_sql()}
SELECT {_alert_id_sql()} AS alert_id,
  '{{"color":"' || {colour} || '","title":"' || severity || ' Alert – ' || sensor_name ||
  '","emphasis":"' || {emph} || '","facts":[{{"title":"Turbine","value":"' || CAST(l_suppkey AS VARCHAR) ||
  '"}},{{"title":"Sensor","value":"' || sensor_name || '"}},{{"title":"Value","value":"' || printf('%.3f', value) ||
  '"}},{{"title":"Threshold","value":"' || printf('%.3f', threshold) || '"}},{{"title":"Time","value":"' ||
  CAST(l_shipdate AS VARCHAR) || '"}}],"text":"' || {desc} || '"}}' AS payload
FROM ev"""


@register("alert_payload", "R9 R2", _payload_sql())
def q_alert_payload(spark, sf_dir):
    from telemetra.operators import alerts as AL
    from telemetra.plans.queries_more import _li_events
    ev, _ = _li_events(spark, sf_dir)
    return AL.alert_payload(ev, asset="l_suppkey", ts="l_shipdate")


# ---------------------------------------------------------------------------
# Streaming: events replayed as daily files through the file stream
# ---------------------------------------------------------------------------

STREAM_FILES = 6


def _events_stream(spark, sf_dir):
    """Replay ``events`` as files of consecutive days in the shared folder; one file per micro-batch."""
    import uuid

    from pyspark.sql import types as T

    from telemetra.session import scratch_path
    from telemetra.streaming import streams as STR

    run = uuid.uuid4().hex[:12]
    src = scratch_path(spark, f"stream_events_{run}")
    ev = cat.events_readings(spark, sf_dir).select("user_id", "ts", "event_id", "event_type", "value")
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01"))
    first, last = ev.agg(F.min(day), F.max(day)).first()
    if first is None:
        ev.write.parquet(src)
    else:
        step = (last - first) // STREAM_FILES + 1
        for start in range(first, last + 1, step):  # in order, so that event time advances file by file
            ev.filter(day.between(start, start + step - 1)).coalesce(1).write.mode("append").parquet(src)
    schema = T.StructType([T.StructField("user_id", T.LongType()),
                           T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("event_id", T.LongType()),
                           T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    return run, STR.stream_readings(spark, src, schema, max_files_per_trigger=1, ts="ts")


def _late_events_stream(spark, sf_dir):
    """``events`` as increments of consecutive days, a folder each; some rows come one increment late, and
    some come again with the next."""
    import uuid

    from telemetra.session import scratch_path
    from telemetra.streaming import streams as STR

    run = uuid.uuid4().hex[:12]
    src = scratch_path(spark, f"stream_late_{run}")
    ev = cat.events_readings(spark, sf_dir).select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").cast("long").alias("event_id"),
        "event_type", F.col("value").cast("double").alias("value"))
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01"))
    first, last = ev.agg(F.min(day), F.max(day)).first()
    step = ((last or 0) - (first or 0)) // STREAM_FILES + 1
    draw = F.pmod(F.xxhash64("event_id"), F.lit(10))
    when = F.floor((day - F.lit(first or 0)) / step).cast("int")
    sent = ev.withColumn("increment", F.explode(
        F.when(draw == 0, F.array(when + 1)).when(draw == 1, F.array(when, when + 1)).otherwise(F.array(when))))
    for i in range(STREAM_FILES + 1):
        sent.filter(F.col("increment") == i).drop("increment").write.mode("append").parquet(f"{src}/increment={i}")
    files = STR.stream_readings(spark, f"{src}/*", ev.schema,
                                max_files_per_trigger=spark.sparkContext.defaultParallelism)
    return run, files, f"{2 * step + 1} days"


def _upserted(spark, df, name, keys, version=None):
    from telemetra.session import scratch_path
    from telemetra.sources import sinks
    path = scratch_path(spark, f"stream_up_{name}")
    sinks.start_upsert_sink(df, path, scratch_path(spark, f"stream_uck_{name}"), available_now=True).awaitTermination()
    return sinks.read_upserts(spark, path, keys, version)


def _run_to_parquet(spark, df, name):
    from telemetra.session import scratch_path
    sink = scratch_path(spark, f"stream_out_{name}")
    q = (df.writeStream.format("parquet").outputMode("append").option("path", sink)
         .option("checkpointLocation", scratch_path(spark, f"stream_ck_{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)  # the sink's log lists committed files only


@register("stream_kpis", "IO3 X1 X5", """WITH m AS (SELECT max(ts) AS mx FROM events),
k AS (SELECT user_id, date_trunc('day', ts) AS window_start,
        date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS reading_count,
        (floor(avg(value) * 16384.0 + 0.5) / 16384.0) AS value_avg, min(value) AS value_min,
        max(value) AS value_max, (floor(stddev_samp(value) * 16384.0 + 0.5) / 16384.0) AS value_std
      FROM events GROUP BY 1, 2)
SELECT k.* FROM k, m WHERE window_end <= mx - INTERVAL 1 HOUR""")
def q_stream_kpis(spark, sf_dir):
    from telemetra.streaming import streams as STR

    run, stream = _events_stream(spark, sf_dir)
    stream = STR.ingest_stream(stream, "ts")
    kpis = STR.kpi_stream(stream, "user_id", "ts", ["value"], window="1 day", delay="1 hour")
    out = _run_to_parquet(spark, kpis, f"kpis_{run}")
    return out.select("user_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                      F.col("reading_count").cast("long"), rnd("value_avg").alias("value_avg"),
                      "value_min", "value_max", rnd("value_std").alias("value_std"))


@register("stream_kpis_late", "IO9 X2 X5", """SELECT user_id, date_trunc('day', ts) AS window_start,
  count(*) AS reading_count, (floor(avg(value) * 16384.0 + 0.5) / 16384.0) AS value_avg, min(value) AS value_min,
  max(value) AS value_max, (floor(stddev_samp(value) * 16384.0 + 0.5) / 16384.0) AS value_std
FROM events GROUP BY 1, 2""")
def q_stream_kpis_late(spark, sf_dir):
    """Late and repeated readings: repeats are dropped across batches, every window comes out, the last ones too."""
    from telemetra.streaming import streams as STR

    run, stream, delay = _late_events_stream(spark, sf_dir)
    once = STR.dedup_stream(stream, ["user_id", "ts", "event_id"], "ts", delay)
    kpis = STR.kpi_stream(once, "user_id", "ts", ["value"], window="1 day", delay=None)
    out = _upserted(spark, kpis, f"kpis_{run}", ["user_id", "window_start"])
    return out.select("user_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("reading_count").cast("long"), rnd("value_avg").alias("value_avg"),
                      "value_min", "value_max", rnd("value_std").alias("value_std"))


@register("stream_zscores", "IO9 W2 W4 X2", """WITH w AS (
  SELECT user_id, ts, event_id, value, value - lag(value) OVER o AS value_rate_of_change, avg(value) OVER f AS m,
    stddev_samp(value) OVER f AS sd FROM events
  WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id),
    f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)),
z AS (SELECT *, CASE WHEN sd > 0 THEN (value - m) / sd ELSE 0.0 END AS z FROM w)
SELECT user_id, ts, event_id, value,
  (floor(value_rate_of_change * 16384.0 + 0.5) / 16384.0) AS value_rate_of_change,
  (floor(z * 16384.0 + 0.5) / 16384.0) AS value_zscore, CAST(abs(z) > 2 AS INT) AS value_anomaly,
  abs(z) > 2 AS is_anomaly FROM z""")
def q_stream_zscores(spark, sf_dir):
    """Rolling z-scores kept in state, over late and repeated readings, equal the batch frames."""
    from telemetra.streaming import streams as STR

    run, stream, delay = _late_events_stream(spark, sf_dir)
    rows = STR.feature_stream(stream, "user_id", "ts", "event_id", ["value"], lookback=20, sigma=2.0,
                              min_sensors=1, delay=delay)
    out = _upserted(spark, rows, f"zscores_{run}", ["user_id", "ts", "event_id"], "version")
    return out.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "value",
                      rnd("value_rate_of_change").alias("value_rate_of_change"),
                      rnd("value_zscore").alias("value_zscore"), "value_anomaly", "is_anomaly")


def _stream_cooldown_sql():
    return """WITH RECURSIVE c AS (
  SELECT CAST(user_id AS VARCHAR) AS k, ts, event_id, value FROM events WHERE value >= 100),
chain AS (
  SELECT k, ts, event_id, value FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, CAST(event_id AS VARCHAR)) AS rn FROM c)
  WHERE rn = 1
  UNION ALL
  SELECT n.k, n.ts, n.event_id, n.value FROM chain p, LATERAL (
    SELECT k, ts, event_id, value FROM c WHERE c.k = p.k AND c.ts >= p.ts + INTERVAL 1440 MINUTE
    ORDER BY ts, CAST(event_id AS VARCHAR) LIMIT 1) n)
SELECT k AS key, CAST(event_id AS VARCHAR) AS event_id, ts, value FROM chain"""


@register("stream_alerts", "X4 R3", _stream_cooldown_sql())
def q_stream_alerts(spark, sf_dir):
    from telemetra.streaming import streams as STR
    run, stream = _events_stream(spark, sf_dir)
    viol = stream.filter(F.col("value") >= 100)
    fired = STR.alert_stream(viol, ["user_id"], "ts", "event_id", "value", cooldown_minutes=1440,
                             delay="1 day")
    out = _run_to_parquet(spark, fired, f"alerts_{run}")
    return out.select("key", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


@register("stream_scores", "X2 X3 S7 S8 S9 S12", f"""SELECT event_id, user_id,
  least(greatest(100 - (CASE WHEN {_EV_Z} > 3 THEN 25 WHEN {_EV_Z} > 2 THEN 10 WHEN {_EV_Z} > 1.5 THEN 3
    ELSE 0 END + CASE WHEN event_type = 'error' THEN 30 ELSE 0 END), 0.0), 100.0) AS health_score,
  (floor(least(greatest({_EV_Z} / 5.0, 0.0), 1.0) * 16384.0 + 0.5) / 16384.0) AS anomaly_score
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS d FROM events) WHERE d = 1""")
def q_stream_scores(spark, sf_dir):
    from telemetra.streaming import streams as STR
    run, stream = _events_stream(spark, sf_dir)
    dedup = STR.dedup_stream(stream.withColumn("fault", EVENTS.fault_col()),
                             ["user_id", "ts"], "ts", "1 hour")
    scored = STR.score_stream(dedup, EVENTS.baselines, fault_col="fault")
    out = _run_to_parquet(spark, scored, f"scores_{run}")
    return out.select("event_id", "user_id", "health_score", rnd("anomaly_score").alias("anomaly_score"))
