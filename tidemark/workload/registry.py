"""All registered queries with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ensure_utc
from tidemark.workload import (
    audit_queries,
    guard_queries,
    load_queries,
    planning_queries,
    readiness_queries,
    run_queries,
)

MODULES = [planning_queries, readiness_queries, guard_queries, load_queries, audit_queries, run_queries]

Query = Callable[[SparkSession, str], DataFrame]


def _in_utc(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ensure_utc(spark), sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _in_utc(q) for module in MODULES for name, q in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
