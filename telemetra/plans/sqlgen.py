"""Helpers that spell out the oracle SQL (DuckDB dialect, ANSI windows).

They follow the operator definitions directly -- plain ``ROWS BETWEEN``
frames, ``row_number`` dedup, ``lag`` fills -- never the Spark-side tricks
(blocks, halos, prefix sums), so the two sides are independent.
"""

from __future__ import annotations

from telemetra.plans.catalog import LINEITEM, LINEITEM_SENSORS

LI_TIE = ", ".join(LINEITEM.tiebreak)
LI_COLS = ("l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, "
           "l_returnflag, l_orderkey, l_linenumber, l_partkey")


def r(expr: str, d: int = 4) -> str:
    """Output rounding matching ``queries_core.rnd`` bit for bit."""
    return f"(floor(({expr}) * 16384.0 + 0.5) / 16384.0)"


def sround(expr: str, d: int) -> str:
    """Spark's ``round`` (HALF_UP on the shortest decimal form of the double)."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 18)), {d}) AS DOUBLE)"


def lineitem_clean_ctes() -> str:
    """CTEs src, dedup, ranged, filled, clean for the lineitem readings."""
    rng = ",\n    ".join(
        f"CASE WHEN {s} BETWEEN {lo} AND {hi} THEN {s} END AS {s}"
        for s, (lo, hi) in LINEITEM.limits.items())
    fill = ",\n    ".join(f"coalesce({s}, lag({s}) OVER w) AS {s}" for s in LINEITEM_SENSORS)
    notnull = " AND ".join(f"{s} IS NOT NULL" for s in LINEITEM_SENSORS)
    return f"""src AS (SELECT {LI_COLS} FROM lineitem),
dedup AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate
                                 ORDER BY {LI_TIE}, l_returnflag) AS rn_
    FROM src) WHERE rn_ = 1),
ranged AS (
  SELECT l_suppkey, l_shipdate, l_returnflag, l_orderkey, l_linenumber, l_partkey,
    {rng}
  FROM dedup),
filled AS (
  SELECT l_suppkey, l_shipdate, l_returnflag, l_orderkey, l_linenumber, l_partkey,
    {fill}
  FROM ranged WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate)),
clean AS (SELECT * FROM filled WHERE {notnull})"""


def zscore_cte(source: str, name: str, asset: str, order: str, sensors, lookback: int = 288,
               sigma: float = 3.0, min_sensors: int = 2) -> str:
    stats = ",\n    ".join(
        f"avg({s}) OVER wz AS m_{s}, stddev_samp({s}) OVER wz AS sd_{s}" for s in sensors)
    zs = ",\n    ".join(
        f"CASE WHEN sd_{s} > 0 THEN ({s} - m_{s}) / sd_{s} ELSE 0.0 END AS {s}_zscore"
        for s in sensors)
    flags = ",\n    ".join(
        f"CASE WHEN abs({s}_zscore) > {sigma} THEN 1 ELSE 0 END AS {s}_anomaly" for s in sensors)
    score = " + ".join(f"{s}_anomaly" for s in sensors)
    return f"""{name}_st AS (
  SELECT *, {stats}
  FROM {source}
  WINDOW wz AS (PARTITION BY {asset} ORDER BY {order}
                ROWS BETWEEN {lookback} PRECEDING AND CURRENT ROW)),
{name}_z AS (SELECT *, {zs} FROM {name}_st),
{name}_f AS (SELECT *, {flags} FROM {name}_z),
{name} AS (SELECT *, {score} AS anomaly_score, ({score}) >= {min_sensors} AS is_anomaly
           FROM {name}_f)"""


def health_sql(temp: str, vib: str, eff: str, anom: str) -> str:
    temp, vib, eff, anom = (f"({x})" for x in (temp, vib, eff, anom))
    t = sround(f"CASE WHEN {temp} < 520 THEN 100.0 WHEN {temp} < 560 THEN 100 - ({temp} - 520) * 1.25 "
               f"WHEN {temp} < 590 THEN 50 - ({temp} - 560) * 1.0 ELSE 10.0 END", 1)
    v = sround(f"CASE WHEN {vib} < 2.5 THEN 100.0 WHEN {vib} < 4.0 THEN 100 - ({vib} - 2.5) * 20 "
               f"WHEN {vib} < 7.0 THEN 70 - ({vib} - 4.0) * 15 ELSE 10.0 END", 1)
    e = sround(f"CASE WHEN {eff} > 95 THEN 100.0 WHEN {eff} > 85 THEN 100 - (95 - {eff}) * 5 "
               f"WHEN {eff} > 70 THEN 50 - (85 - {eff}) * 2 ELSE 10.0 END", 1)
    s0 = sround(f"CAST(100 - {anom} * 15 AS DOUBLE)", 1)
    s = f"CASE WHEN {s0} < 0 THEN 0.0 ELSE {s0} END"
    return f"{t} AS temp_health, {v} AS vibration_health, {e} AS efficiency_health, {s} AS stability_health"


RISK = ("CASE WHEN {x} >= 80 THEN 'LOW' WHEN {x} >= 60 THEN 'MEDIUM' "
        "WHEN {x} >= 40 THEN 'HIGH' ELSE 'CRITICAL' END")
