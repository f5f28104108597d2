"""Registry of named queries: Spark plan + independent SQL oracle.

Each query reads the driver's tables (whole tables, no row caps) through
:mod:`telemetra.plans.catalog` and runs library operators.  The SQL is
written from the operator's definition (direct window frames, plain
aggregates) and is what DuckDB runs as the correctness oracle.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str  # SURVEY inventory ids covered


REGISTRY: dict[str, Query] = {}


def register(name: str, ids: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, ids)
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # importing the modules fills REGISTRY
    from telemetra.plans import queries_checks, queries_core, queries_more, queries_reports  # noqa: F401
    return dict(REGISTRY)
