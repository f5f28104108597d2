"""Tiered batch flow raw -> features -> KPIs (P8) with gates between the tiers.

Each tier is one lazy plan written once (Parquet) and read back, so the next
tier starts from a short lineage and counts come from written tables.  After a
tier its gates are judged on the written table; a failed gate stops the run
before the next tier is begun.  Every step leaves a row in the run ledger
(``<base>/run_ledger``): a run that is started again under its name goes on at
the step that failed.  A step's shuffles and scratch tables are deleted when it
ends, so the disk holds the tiers and what one step needs.
"""

from __future__ import annotations

import os
import time
import uuid
from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.operators import clean as C
from telemetra.operators import features as FT
from telemetra.operators import kpi as K
from telemetra.plans.reports import bronze_gates, gold_gates, silver_gates
from telemetra.profile import SensorProfile
from telemetra.session import step_files
from telemetra.sources import sinks

SLA_MINUTES = 120
LEDGER = "run string, tier string, status string, rows long, seconds double, number long, run_at timestamp"


class GateFailure(RuntimeError):
    """A required quality gate failed; the run can be started again under its name."""


class _Run:
    def __init__(self, spark: SparkSession, base: str, name: str):
        self.spark, self.path, self.name = spark, os.path.join(base, "run_ledger"), name
        self.rows: list[tuple] = []
        before = spark.read.schema(LEDGER).parquet(self.path) if sinks._exists(spark, self.path) else None
        # one row per tier of this run
        self.done = {} if before is None else {r["tier"]: r["status"] for r in before.filter(
            F.col("run") == name).groupBy("tier").agg(F.max_by("status", "number").alias("status")).collect()}
        self.number = 0 if before is None else (before.agg(F.max("number")).first()[0] or 0)

    def record(self, tier: str, status: str, rows: int, since: float) -> None:
        self.number += 1
        row = (self.name, tier, status, int(rows), round(time.perf_counter() - since, 3), self.number)
        self.rows.append(row)
        self.spark.createDataFrame([row], LEDGER.rsplit(",", 1)[0]).withColumn("run_at", F.current_timestamp()) \
            .write.mode("append").parquet(self.path)

    def step(self, tier: str, write: Callable[[], DataFrame], read: Callable[[], DataFrame],
             gates: Callable[[DataFrame], DataFrame], gates_path: str, stop: bool) -> tuple[DataFrame, int]:
        """Write a tier unless an earlier start did, then judge it; the table and the number of failed gates."""
        since = time.perf_counter()
        if self.done.get(tier) != "written":
            with step_files(self.spark):
                write()
            self.record(tier, "written", read().count(), since)
        table = read()
        judged = os.path.join(gates_path, f"tier={tier}")
        with step_files(self.spark):
            sinks.write_overwrite(gates(table).drop("tier"), judged)
        failed = self.spark.read.parquet(judged).filter(~F.col("passed")).count()
        self.record(f"{tier} gates", "passed" if not failed else f"failed:{failed}", failed, since)
        if failed and stop:
            raise GateFailure(f"{failed} quality gate(s) of {tier} failed; see {gates_path}")
        return table, failed


def run_batch(spark: SparkSession, raw: DataFrame, alarms: DataFrame | None,
              profile: SensorProfile, base: str, health_roles: Mapping[str, str],
              kpi_grain: str = "hour", stop_on_gate_failure: bool = True,
              sla_minutes: float = SLA_MINUTES, run: str | None = None, source: str = "raw",
              bucket_col: str = "hour_bucket", gate_config: Mapping | None = None) -> DataFrame:
    """Run raw -> features -> KPIs; return the run log (tier, status, rows, seconds).

    ``raw`` is any frame of readings; its rows replace those that ``source``
    had before (rows with their own ``source_file`` replace that source's).
    The feature tier is :func:`features.silver_features` of the cleaned rows.
    ``health_roles``: temp/vibration/efficiency/anomaly expressions over the
    KPI columns (see :func:`kpi.with_health`).  With ``run`` given, tiers that
    an earlier start of that run wrote are read, not written again, and all
    gates are judged anew; a failed gate raises :class:`GateFailure`, unless
    ``stop_on_gate_failure`` is off.
    """
    began = time.perf_counter()
    name = run or uuid.uuid4().hex
    flow = _Run(spark, base, name)
    at = {t: os.path.join(base, t) for t in ("bronze", "silver", "gold_kpis", "gold_latest", "gold_alert_history")}
    gates_path = os.path.join(base, "gates", f"run={name}")
    columns = raw.columns

    def bronze() -> None:
        named = raw if "source_file" in columns else raw.withColumn("source_file", F.lit(source))
        dated = named.withColumns({"data_quality_flag": F.lit("raw"), "ingestion_timestamp": F.current_timestamp(),
                                   "year": F.year(profile.ts), "month": F.month(profile.ts)})
        sinks.commit_sources(dated, at["bronze"], batch=name)

    bronze_t, failed = flow.step(
        "bronze", bronze, lambda: sinks.read_committed(spark, at["bronze"]),
        lambda t: bronze_gates(t.select(*columns), profile, gate_config), gates_path, stop_on_gate_failure)

    def silver() -> None:
        clean = C.clean_readings(bronze_t.select(*columns), profile, keep_sequence=True, with_count=False)
        # the feature pass deals rows by asset and block: an asset lies in few files without one more shuffle
        sinks.write_overwrite(FT.silver_features(clean, profile), at["silver"])

    silver_t, more = flow.step("silver", silver, lambda: spark.read.parquet(at["silver"]),
                               lambda t: silver_gates(t, profile, gate_config), gates_path, stop_on_gate_failure)
    failed += more

    def gold() -> None:
        kpis = K.with_health(K.hourly_kpis(silver_t, profile, grain=kpi_grain, bucket_col=bucket_col), **health_roles)
        sinks.write_overwrite(kpis, at["gold_kpis"], cluster_by=(profile.asset,))
        written = spark.read.parquet(at["gold_kpis"])
        sinks.write_overwrite(K.latest_per_asset(written, profile.asset, bucket_col), at["gold_latest"])
        if alarms is not None:
            sinks.write_overwrite(K.alert_history(alarms), at["gold_alert_history"])

    tables = {"gold_turbine_hourly_kpis": "gold_kpis", "gold_turbine_latest_status": "gold_latest",
              "gold_alert_history": "gold_alert_history"}
    _, more = flow.step("gold", gold, lambda: spark.read.parquet(at["gold_kpis"]),
                        lambda t: gold_gates(t, profile, [n for n, p in tables.items() if sinks._exists(spark, at[p])],
                                             gate_config), gates_path, stop_on_gate_failure)
    failed += more
    flow.record("gates", "passed" if not failed else f"failed:{failed}", failed, began)
    late = time.perf_counter() - began > sla_minutes * 60
    flow.record("run", "sla_breach" if late else "ok", 0, began)
    return spark.createDataFrame([r[1:5] for r in flow.rows], "tier string, status string, rows long, seconds double") \
        .withColumn("run_at", F.current_timestamp())
