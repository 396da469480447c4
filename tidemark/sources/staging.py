"""Staged tables: named after their job or, in the older way, after their target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def staged_table(
    spark: SparkSession, job: str, table: str, schema: str = "", suffix: str = "tmp_validation"
) -> DataFrame:
    """``{job}_{suffix}`` when it exists, else ``{table}_{suffix}``, with fresh file listings."""
    prefix = f"{schema}." if schema else ""
    name = f"{prefix}{job}_{suffix}" if job else f"{prefix}{table}_{suffix}"
    if not spark.catalog.tableExists(name):
        name = f"{prefix}{table}_{suffix}"
    spark.catalog.refreshTable(name)
    return spark.table(name)
