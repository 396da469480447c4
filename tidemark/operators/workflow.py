"""Completion of external workflows that write a prerequisite table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NEVER = "0001-01-01"


def last_completions(
    writes: DataFrame, history: DataFrame, folder_schemas: DataFrame,
    excluded_types: DataFrame, excluded_workflows: DataFrame,
) -> DataFrame:
    """Per written table and workflow, the last day it succeeded (null when never).

    ``writes``: folder_nm, workflow_nm, tgt_obj, workflow_type, obs_ind; ``history``:
    folder_nm, workflow_nm, stat, xtr_end_dt. A folder maps to a schema by lookup.
    """
    writers = (
        writes.filter("obs_ind = 0")
        .join(excluded_types, "workflow_type", "left_anti")
        .join(excluded_workflows, "workflow_nm", "left_anti")
        .select("folder_nm", "workflow_nm", "tgt_obj").distinct()
        .join(folder_schemas, "folder_nm")
    )
    finished = (
        history.filter("stat = 'Succeeded'")
        .groupBy("folder_nm", "workflow_nm")
        .agg(F.max(F.to_date("xtr_end_dt")).alias("last_day"))
    )
    return writers.join(finished, ["folder_nm", "workflow_nm"], "left").select(
        F.upper("schema_nm").alias("schema_key"), F.upper("tgt_obj").alias("table_key"),
        "workflow_nm", "last_day",
    )


def worst_days(dependencies: DataFrame, completions: DataFrame) -> DataFrame:
    """Per dependency, the earliest last success among the workflows writing its table.

    ``dependencies``: dep_id, schema_nm, table_nm, names (array, or null for all). A
    dependency nobody writes has no row. Dependencies on all workflows meet one row per
    table; those on named ones meet just these.
    """
    table = ["schema_key", "table_key"]
    wanted = dependencies.select(
        "dep_id", F.upper("schema_nm").alias("schema_key"),
        F.upper("table_nm").alias("table_key"), "names",
    )
    finished = completions.withColumn("last_day", F.coalesce("last_day", F.lit(_NEVER).cast("date")))
    any_name = F.coalesce(F.size("names"), F.lit(0)) < 1
    by_table = finished.groupBy(*table).agg(F.min("last_day").alias("worst_day"))
    of_all = wanted.filter(any_name).join(by_table, table).select("dep_id", "worst_day")
    of_named = (
        wanted.filter(~any_name).withColumn("workflow_nm", F.explode(F.array_distinct("names")))
        .join(finished, [*table, "workflow_nm"]).select("dep_id", F.col("last_day").alias("worst_day"))
    )
    return of_all.unionByName(of_named).groupBy("dep_id").agg(F.min("worst_day").alias("worst_day"))


def workflow_complete(
    dependencies: DataFrame, targets: DataFrame, completions: DataFrame
) -> DataFrame:
    """Per dependency and target day: have all workflows writing its table finished?

    A workflow is done for a day when it succeeded on or after it, and the worst workflow
    decides; so one day per dependency answers all its target days, and days never meet
    workflows. No workflow found means not ready. ``targets``: dep_id, target_day.
    """
    return targets.join(worst_days(dependencies, completions), "dep_id", "left").select(
        "dep_id", "target_day",
        F.coalesce(F.col("worst_day") >= F.col("target_day"), F.lit(False)).alias("ready"),
    )
