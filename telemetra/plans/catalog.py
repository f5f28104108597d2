"""The driver's test tables seen as telemetry.

* ``events``   -> single-sensor stream: asset = user_id, sensor = value,
                  fault = event_type 'error', tiebreak event_id.
* ``lineitem`` -> four-sensor readings: asset = l_suppkey, ts = l_shipdate,
                  sensors quantity / extendedprice / discount / tax,
                  fault = l_returnflag 'R'.
* ``orders``   -> alarm log: asset = o_custkey, ts = o_orderdate,
                  code = o_orderpriority, severity = o_orderstatus,
                  value = o_totalprice.

Limits and baselines below are parameters of these mappings (chosen so
every branch of the cleaning and scoring rules is exercised), not values of
the source application.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.profile import SensorProfile
from telemetra.sources.readers import read_table

LINEITEM_SENSORS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

LINEITEM = SensorProfile(
    asset="l_suppkey", ts="l_shipdate", sensors=LINEITEM_SENSORS,
    tiebreak=("l_orderkey", "l_linenumber", "l_partkey", *LINEITEM_SENSORS),
    limits={"l_quantity": (1.0, 45.0), "l_extendedprice": (0.0, 95000.0),
            "l_discount": (0.0, 0.09), "l_tax": (0.0, 0.08)},
    baselines={"l_quantity": (25.5, 14.4), "l_extendedprice": (38000.0, 23000.0),
               "l_discount": (0.05, 0.032), "l_tax": (0.04, 0.026)},
    fault="l_returnflag = 'R'", chunk_seconds=1024 * 30 * 86400,  # days between readings: slots of a month
)

EVENTS = SensorProfile(
    asset="user_id", ts="ts", sensors=("value",), tiebreak=("event_id",),
    limits={"value": (0.0, 400.0)}, baselines={"value": (50.0, 50.0)},
    fault="event_type = 'error'", chunk_seconds=1024 * 86400,  # slots of a day
)

ORDERS_ALARMS = SensorProfile(
    asset="o_custkey", ts="o_orderdate", sensors=("o_totalprice",), tiebreak=("o_orderkey",),
    fault="o_orderstatus = 'F'", chunk_seconds=1024 * 365 * 86400,  # slots of a year
)

# health inputs for lineitem KPIs (scaled onto the pipeline's health bands)
LINEITEM_HEALTH = dict(
    temp="l_extendedprice_avg / 100",
    vibration="l_quantity_avg / 5",
    efficiency="100 - 300 * l_discount_avg",
    anomaly="avg_anomaly_score",
)

DRIFT_SPLIT = "2024-01-16"


def path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, path(sf_dir, "lineitem")).select(
        "l_suppkey", "l_shipdate", *LINEITEM_SENSORS, "l_returnflag",
        "l_orderkey", "l_linenumber", "l_partkey")


def events_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, path(sf_dir, "events")).select(
        "event_id", "ts", "user_id", "event_type", "value")


def orders_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, path(sf_dir, "orders"))
    return o.select(
        F.col("o_orderkey"), F.col("o_custkey").alias("turbine_id"),
        F.col("o_orderdate").alias("timestamp"), F.col("o_orderpriority").alias("alarm_code"),
        F.col("o_orderstatus").alias("severity"), F.col("o_totalprice").alias("sensor_value"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("alarm_description"),
        F.round(F.col("o_totalprice") / 1000, 0).alias("threshold"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, path(sf_dir, name))
