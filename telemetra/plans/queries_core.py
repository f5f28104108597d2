"""Core registered queries: cleaning, windows, KPIs (C, W, A1-A5, S1-S7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.operators import clean as C
from telemetra.operators import features as FT
from telemetra.operators import kpi as K
from telemetra.operators import stats as ST
from telemetra.plans import catalog as cat
from telemetra.plans.catalog import EVENTS, LINEITEM, LINEITEM_HEALTH, LINEITEM_SENSORS
from telemetra.plans.registry import register
from telemetra.plans.sqlgen import (RISK, health_sql, lineitem_clean_ctes, r, sround,
                                    zscore_cte)

S = LINEITEM_SENSORS


def rnd(c, d=4):
    """Output rounding shared with the SQL side: nearest multiple of 2**-14.

    Both engines evaluate floor(x * 16384 + 0.5) / 16384 with identical
    double arithmetic.  A binary quantum never meets an exact half for
    decimal fixed-point data (means of 2-decimal values), whereas decimal
    rounding does, and then ulp-level differences in summation order would
    flip the last digit.  ``d`` is kept for call-site readability.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * F.lit(QUANTUM) + 0.5).cast("double") / F.lit(QUANTUM)


QUANTUM = 16384.0


def _round_all(df, cols, d=4):
    return df.withColumns({c: rnd(c, d) for c in cols})


# ---------------------------------------------------------------------------
# flagship: clean -> z-score flags -> monthly KPIs -> health and risk
# ---------------------------------------------------------------------------

def gold_kpis_frame(spark, sf_dir):
    readings = cat.lineitem_readings(spark, sf_dir)
    clean = C.clean_readings(readings, LINEITEM, keep_sequence=True, carry=())
    flagged = FT.zscore_flags(clean, LINEITEM, lookback=288)
    kpis = K.hourly_kpis(flagged, LINEITEM, grain="month", bucket_col="month_bucket")
    return K.with_health(kpis, **LINEITEM_HEALTH)


def _gold_select(df):
    aggs = [f"{s}_{a}" for s in S for a in ("avg", "min", "max", "std")]
    return _round_all(df, aggs + ["avg_anomaly_score"]).select(
        "l_suppkey", "month_bucket", *aggs, F.col("reading_count").cast("long"),
        F.col("anomaly_count").cast("long"), "avg_anomaly_score", "temp_health",
        "vibration_health", "efficiency_health", "stability_health", "health_score",
        "risk_level")


def _gold_sql():
    aggs = ",\n    ".join(
        f"{r(f'avg({s})')} AS {s}_avg, {r(f'min({s})')} AS {s}_min, "
        f"{r(f'max({s})')} AS {s}_max, {r(f'stddev_samp({s})')} AS {s}_std" for s in S)
    return f"""WITH {lineitem_clean_ctes()},
{zscore_cte('clean', 'silver', 'l_suppkey', 'l_shipdate', S)},
kpi AS (
  SELECT l_suppkey, date_trunc('month', l_shipdate) AS month_bucket,
    avg(l_extendedprice) AS pe_, avg(l_quantity) AS qa_, avg(l_discount) AS da_,
    avg(anomaly_score) AS as_,
    {aggs},
    count(*) AS reading_count,
    sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS anomaly_count
  FROM silver GROUP BY 1, 2),
h AS (
  SELECT *, {health_sql('pe_ / 100', 'qa_ / 5', '100 - 300 * da_', 'as_')} FROM kpi),
hs AS (
  SELECT *, {sround('temp_health * 0.25 + vibration_health * 0.25 + efficiency_health * 0.25 + stability_health * 0.25', 1)} AS health_score FROM h)
SELECT * EXCLUDE (pe_, qa_, da_, as_), (floor(as_ * 16384.0 + 0.5) / 16384.0) AS avg_anomaly_score,
       {RISK.format(x='health_score')} AS risk_level
FROM hs"""


@register("gold_kpis", "C2 C3 C4 C5 W4 A1 S2 S3 S4 S5 S6 S7", _gold_sql())
def q_gold_kpis(spark, sf_dir):
    return _gold_select(gold_kpis_frame(spark, sf_dir))


# ---------------------------------------------------------------------------
# C1-C5 cleaning
# ---------------------------------------------------------------------------

@register("clean_readings", "C2 C3 C4 C5", f"""WITH {lineitem_clean_ctes()}
SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag
FROM clean""")
def q_clean_readings(spark, sf_dir):
    out = C.clean_readings(cat.lineitem_readings(spark, sf_dir), LINEITEM)
    return out.select("l_suppkey", "l_shipdate", *S, "l_returnflag")


def _full_fill_sql():
    rng = ",\n    ".join(
        f"CASE WHEN {s} BETWEEN {lo} AND {hi} THEN {s} END AS {s}"
        for s, (lo, hi) in LINEITEM.limits.items())
    fill = ",\n    ".join(
        f"last_value({s} IGNORE NULLS) OVER w AS {s}" for s in S)
    return f"""WITH src AS (SELECT * FROM lineitem),
ranged AS (SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey,
    l_quantity AS q0, l_extendedprice AS p0, l_discount AS d0, l_tax AS t0, {rng} FROM src)
SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, {fill}
FROM ranged
WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey,
             q0, p0, d0, t0 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@register("fill_full", "C3 C4", _full_fill_sql())
def q_fill_full(spark, sf_dir):
    x = cat.lineitem_readings(spark, sf_dir)
    x = C.null_out_of_range(x, LINEITEM.limits)
    # order on the raw values: keep them beside the nulled ones
    x = x.withColumns({f"_o_{s}": F.col(s) for s in S})
    prof = LINEITEM.with_(tiebreak=("l_orderkey", "l_linenumber", "l_partkey",
                                    *[f"_o_{s}" for s in S]), block_rows=64)
    out = C.fill_previous(x, prof, S, mode="full")
    return out.select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", *S)


@register("validate_rows", "C1", """SELECT event_id, user_id,
  CASE WHEN value BETWEEN 0.0 AND 400.0 THEN '' ELSE 'value out of [0.0, 400.0]' END AS reasons
FROM events
WHERE NOT (value BETWEEN 0.0 AND 400.0)""")
def q_validate_rows(spark, sf_dir):
    tagged = C.split_valid(cat.events_readings(spark, sf_dir), EVENTS.limits)
    return C.rejected_rows(tagged).select("event_id", "user_id", "reasons")


@register("physics_cross", "C6 S1", """SELECT l_orderkey, l_linenumber,
  (floor((l_extendedprice / l_quantity) * 16384.0 + 0.5) / 16384.0) AS pressure_ratio,
  (floor((l_tax * 3600 * 45 / (l_discount + 0.01)) * 16384.0 + 0.5) / 16384.0) AS heat_rate,
  (floor((least(greatest(l_discount / (l_tax * 45 + 0.01) * 100 / 0.38, 50.0), 110.0)) * 16384.0 + 0.5) / 16384.0) AS efficiency_pct,
  (floor((l_extendedprice - l_quantity) * 16384.0 + 0.5) / 16384.0) AS temp_differential,
  (floor((l_tax / (l_discount + 0.001)) * 16384.0 + 0.5) / 16384.0) AS specific_fuel_consumption,
  (floor((l_quantity / (l_extendedprice / 1000 + 0.001)) * 16384.0 + 0.5) / 16384.0) AS vibration_speed_ratio,
  (floor((CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice / (l_quantity * (l_quantity / l_tax + 0.001)) END) * 16384.0 + 0.5) / 16384.0) AS compression_efficiency,
  (floor((l_extendedprice / (l_discount + 0.001)) * 16384.0 + 0.5) / 16384.0) AS temp_load_ratio
FROM lineitem""")
def q_physics_cross(spark, sf_dir):
    li = cat.table(spark, sf_dir, "lineitem")
    x = C.with_physics(li, discharge="l_extendedprice", inlet="l_quantity", fuel="l_tax",
                       load="l_discount")
    x = FT.cross_sensor(x, egt="l_extendedprice", cdt="l_quantity", fuel="l_tax",
                        load="l_discount", vibration="l_quantity", rpm="l_extendedprice",
                        discharge="l_extendedprice", inlet="l_quantity", ambient="l_tax")
    cols = ["pressure_ratio", "heat_rate", "efficiency_pct", "temp_differential",
            "specific_fuel_consumption", "vibration_speed_ratio", "compression_efficiency",
            "temp_load_ratio"]
    return _round_all(x, cols).select("l_orderkey", "l_linenumber", *cols)


# ---------------------------------------------------------------------------
# W1-W4 windows
# ---------------------------------------------------------------------------

def _li_order():
    return ", ".join(["l_shipdate", *LINEITEM.tiebreak])


def _rolling_sql():
    cols = []
    for w in (12, 144):
        for s in S:
            frame = f"(PARTITION BY l_suppkey ORDER BY {_li_order()} ROWS BETWEEN {w} PRECEDING AND CURRENT ROW)"
            cols += [f"floor(avg({s}) OVER {frame} * 16384.0 + 0.5) / 16384.0 AS {s}_rolling_mean_{w}",
                     f"floor(stddev_samp({s}) OVER {frame} * 16384.0 + 0.5) / 16384.0 AS {s}_rolling_std_{w}",
                     f"min({s}) OVER {frame} AS {s}_rolling_min_{w}",
                     f"max({s}) OVER {frame} AS {s}_rolling_max_{w}"]
    return (f"SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, "
            + ",\n  ".join(cols) + "\nFROM lineitem")


@register("rolling_features", "W1", _rolling_sql())
def q_rolling_features(spark, sf_dir):
    x = FT.rolling_stats(cat.lineitem_readings(spark, sf_dir), LINEITEM, windows=(12, 144))
    cols = [f"{s}_rolling_{st}_{w}" for w in (12, 144) for s in S
            for st in ("mean", "std", "min", "max")]
    x = x.withColumns({c: rnd(c, 3) for c in cols if "_mean_" in c or "_std_" in c})
    return x.select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", *cols)


@register("rate_of_change", "W2 W3", """SELECT event_id, user_id,
  (floor((value - lag(value) OVER w) * 16384.0 + 0.5) / 16384.0) AS value_rate_of_change,
  (floor(((value - lag(value) OVER w) - (lag(value) OVER w - lag(value, 2) OVER w)) * 16384.0 + 0.5) / 16384.0) AS value_acceleration
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def q_rate_of_change(spark, sf_dir):
    x = FT.rate_of_change(cat.events_readings(spark, sf_dir), EVENTS.with_(block_rows=16))
    return _round_all(x, ["value_rate_of_change", "value_acceleration"]).select(
        "event_id", "user_id", "value_rate_of_change", "value_acceleration")


@register("zscore_flags", "W4", f"""WITH {zscore_cte('events', 'z', 'user_id', 'ts, event_id', ['value'], lookback=12, sigma=1.5, min_sensors=1)}
SELECT event_id, user_id, (floor(value_zscore * 16384.0 + 0.5) / 16384.0) AS value_zscore, value_anomaly,
       anomaly_score, is_anomaly FROM z""")
def q_zscore_flags(spark, sf_dir):
    x = FT.zscore_flags(cat.events_readings(spark, sf_dir), EVENTS.with_(block_rows=32),
                        lookback=12, sigma=1.5, min_sensors=1)
    return x.select("event_id", "user_id", rnd("value_zscore", 4).alias("value_zscore"),
                    "value_anomaly", "anomaly_score", "is_anomaly")


@register("latest_status", "W5", f"""WITH k AS (
  SELECT user_id, date_trunc('hour', ts) AS hour_bucket, count(*) AS reading_count,
         (floor(avg(value) * 16384.0 + 0.5) / 16384.0) AS value_avg
  FROM events GROUP BY 1, 2)
SELECT user_id, hour_bucket, reading_count, value_avg FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY hour_bucket DESC) AS rn FROM k)
WHERE rn = 1""")
def q_latest_status(spark, sf_dir):
    ev = cat.events_readings(spark, sf_dir)
    k = K.hourly_kpis(ev, EVENTS, grain="hour", derived={})
    k = k.select("user_id", "hour_bucket", F.col("reading_count").cast("long"),
                 rnd("value_avg", 4).alias("value_avg"))
    return K.latest_per_asset(k, "user_id", "hour_bucket")


@register("alert_history", "A2", """SELECT o_custkey AS turbine_id,
  date_trunc('hour', o_orderdate) AS hour_bucket, o_orderpriority AS alarm_code,
  o_orderstatus AS severity, count(*) AS occurrence_count,
  (floor(avg(o_totalprice) * 16384.0 + 0.5) / 16384.0) AS avg_sensor_value,
  arg_min('order ' || CAST(o_orderkey AS VARCHAR), o_orderkey) AS description,
  arg_min(round(o_totalprice / 1000, 0), o_orderkey) AS threshold
FROM orders GROUP BY 1, 2, 3, 4""")
def q_alert_history(spark, sf_dir):
    alarms = cat.orders_alarms(spark, sf_dir)
    out = K.alert_history(alarms, tiebreak=("o_orderkey",))
    return out.select("turbine_id", "hour_bucket", "alarm_code", "severity",
                      F.col("occurrence_count").cast("long"),
                      rnd("avg_sensor_value", 4).alias("avg_sensor_value"),
                      "description", "threshold")


@register("quality_profile", "A3", """WITH t AS (
  SELECT count(*) AS total_rows,
         count(*) - count(DISTINCT (l_suppkey, l_shipdate)) AS duplicate_count,
         count(DISTINCT l_suppkey) AS assets, min(l_shipdate) AS first_ts,
         max(l_shipdate) AS last_ts
  FROM lineitem),
n AS (
  SELECT 'l_suppkey' AS column, count(*) FILTER (WHERE l_suppkey IS NULL) AS null_count FROM lineitem
  UNION ALL SELECT 'l_shipdate', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem
  UNION ALL SELECT 'l_quantity', count(*) FILTER (WHERE l_quantity IS NULL OR l_quantity > 45) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', count(*) FILTER (WHERE l_extendedprice IS NULL) FROM lineitem)
SELECT t.*, n.column, n.null_count FROM t CROSS JOIN n""")
def q_quality_profile(spark, sf_dir):
    li = cat.table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate",
        F.when(F.col("l_quantity") <= 45, F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice")
    return ST.quality_profile(li, LINEITEM)


@register("feature_report", "A4 A5 C8", f"""WITH {lineitem_clean_ctes()},
{zscore_cte('clean', 'silver', 'l_suppkey', 'l_shipdate', S)}
SELECT count(*) AS total_records, count(DISTINCT l_suppkey) AS assets,
  min(l_shipdate) AS first_ts, max(l_shipdate) AS last_ts,
  round(avg(CASE WHEN is_anomaly THEN 1.0 ELSE 0.0 END) * 100, 2) AS anomaly_rate_pct,
  round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) * 100, 1) AS positive_ratio_pct
FROM silver""")
def q_feature_report(spark, sf_dir):
    readings = cat.lineitem_readings(spark, sf_dir)
    clean = C.clean_readings(readings, LINEITEM, keep_sequence=True, carry=("l_returnflag",))
    flagged = FT.zscore_flags(clean, LINEITEM, lookback=288)
    labelled = C.with_fault_label(flagged, "l_returnflag = 'R'")
    rep = ST.feature_report(labelled, LINEITEM, label_col="is_faulty")
    return rep.select("total_records", "assets", "first_ts", "last_ts", "anomaly_rate_pct",
                      "positive_ratio_pct")
