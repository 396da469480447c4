"""Audit events and the run state folded from them.

Nothing is updated in place: every start, status change, completion and deletion is a row
appended to the event table, and the state of a run is what its events add up to.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas

RUN_KEY = ["log_kind", "job_nm", "tasksgroup_nm", "round_time", "dag_run_id"]
# The steps of a run, in order.
STEPS = [
    ("FW:2", "FW CHECK PREREQUISITE"),
    ("FW:3", "FW RUN SCRIPTS TRANSFORMATION"),
    ("FW:4", "FW VALIDATION PROCESS"),
]


def duration(start: Column, end: Column) -> Column:
    """``HH:MM:SS``; the hours may exceed 24."""
    seconds = F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))
    return F.format_string(
        "%02d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60
    )


# --- events ----------------------------------------------------------------------------


def _start_event(runs: DataFrame, kind: str, extra: Sequence[str]) -> DataFrame:
    return runs.select(
        F.lit(kind).alias("log_kind"), "job_nm", "tasksgroup_nm", "round_time", "dag_run_id",
        "schema_nm", "table_nm", "job_start_time", "ictrl_dt", "start_ictrl_dt", "end_ictrl_dt",
        F.col("ictrl_dt_tgtfmt").alias("pattern_ictrl_dt"), "load_type", *extra,
        F.lit(schemas.RUNNING).alias("status"), F.col("job_start_time").alias("event_time"),
    )


def start_trans(runs: DataFrame) -> DataFrame:
    """A RUNNING event per planned transform run."""
    return _start_event(runs, "trans", ())


def start_ingest(runs: DataFrame) -> DataFrame:
    """A RUNNING event per planned ingest run, with its kind of ingestion."""
    return _start_event(runs, "ingest", ("ingestion_type",))


def status_event(runs: DataFrame, status: Column, end: Column, error: Column) -> DataFrame:
    return runs.select(
        *RUN_KEY, status.alias("status"), end.alias("job_end_time"), error.alias("err_msg"),
        end.alias("event_time"),
    )


def completion(runs: DataFrame) -> DataFrame:
    """The closing event: status, error, rows, link and duration; ingest logs no row count."""
    took = duration(F.col("job_start_time"), F.col("job_end_time"))
    return runs.select(
        *RUN_KEY, "status", F.coalesce("err_msg", F.lit("-")).alias("err_msg"),
        F.when(F.col("log_kind") != "ingest", F.col("row_cnt")).alias("row_cnt"),
        "log_url", took.alias("duration"), "job_end_time", F.col("job_end_time").alias("event_time"),
    )


def deletion(runs: DataFrame, at: Column) -> DataFrame:
    """A tombstone: the run's earlier events no longer count."""
    return runs.select(*RUN_KEY, F.lit(True).alias("deleted"), at.alias("event_time"))


def steps(runs: DataFrame) -> DataFrame:
    """Detail row per finished step, with the step that follows it, if any.

    ``runs`` holds the run key and ``step_times``: the start and the end of each step, in
    order. A run has three steps, so looking ahead stays within a run's own few rows.
    """
    names = F.array(*[
        F.struct(F.lit(seq).alias("step_seq"), F.lit(name).alias("step_run")) for seq, name in STEPS
    ])
    order = Window.partitionBy(*RUN_KEY).orderBy("step_seq")
    return (
        runs.withColumn("step", F.explode(F.arrays_zip(
            names.alias("name"), F.col("step_times").alias("time")
        )))
        .select(*RUN_KEY, "step.name.*", F.col("step.time.start").alias("job_start_time"),
                F.col("step.time.end").alias("job_end_time"))
        .withColumn("duration", duration(F.col("job_start_time"), F.col("job_end_time")))
        .withColumn("step_seq_next", F.lead("step_seq").over(order))
        .withColumn("step_run_next", F.lead("step_run").over(order))
    )


def next_steps(detail: DataFrame) -> DataFrame:
    """The rows announcing a next step, for the steps that have one."""
    return detail.filter(F.col("step_seq_next").isNotNull()).select(
        *RUN_KEY, F.col("step_run_next").alias("step_run"), F.col("step_seq_next").alias("step_seq")
    )


# --- state ----------------------------------------------------------------------------


def snapshot(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mergeable state of each run: per column the newest value that is not null, with its time and phase.

    Events of the same time count in the order of a run: its start, a change of status, its
    completion; and what is still equal goes by the value itself, so the state does not
    depend on the order of the rows, nor on which events were folded together first. Aggregated
    map-side, so one run with very many events costs one row per task. ``_died`` and ``_lives`` are the
    times of the last tombstone and of the last other event.
    """
    def has(column: str) -> Column:
        return F.col(column).isNotNull() if column in events.columns else F.lit(False)

    started = (F.col("status") == schemas.RUNNING) if "status" in events.columns else F.lit(False)
    phase = F.when(has("duration") | has("log_url"), 2).when(F.coalesce(started, F.lit(False)), 0).otherwise(1)
    deleted = F.col("deleted").cast("boolean") if "deleted" in events.columns else F.lit(None).cast("boolean")
    died = F.max(F.when(deleted, F.col("event_time"))).alias("_died")
    lives = F.max(F.when(deleted.isNull(), F.col("event_time"))).alias("_lives")
    newest = [
        F.max(F.when(F.col(c).isNotNull(), F.struct("event_time", phase.alias("phase"), F.col(c).alias("value")))).alias(c)
        for c in columns
    ]
    return events.groupBy(*RUN_KEY).agg(*newest, died, lives)


def combine(old: DataFrame, new: DataFrame) -> DataFrame:
    """The snapshot of the events of two snapshots of the same columns, no run twice in either.

    Meant for a large ``old`` and a small ``new``: the old one is not shuffled while the new is below
    the broadcast threshold.
    """
    def same(left: str, right: str) -> Column:  # a run may have no task group
        return reduce(Column.__and__, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in RUN_KEY])

    state = [c for c in old.columns if c not in RUN_KEY]
    both = old.alias("o").join(new.alias("n"), same("o", "n"), "left").select(
        *[F.col(f"o.{c}").alias(c) for c in RUN_KEY], *[F.greatest(f"o.{c}", f"n.{c}").alias(c) for c in state])
    known = old.alias("o").join(new.alias("n"), same("o", "n"), "left_semi").select(*RUN_KEY)
    added = new.alias("n").join(known.alias("o"), same("o", "n"), "left_anti")
    return both.unionByName(added)


def current(state: DataFrame) -> DataFrame:
    """The runs of a snapshot with their values; a deleted run is gone unless a later event brought it back."""
    values = [F.col(c)["value"].alias(c) for c in state.columns if c not in (*RUN_KEY, "_died", "_lives")]
    return state.filter("_lives IS NOT NULL AND (_died IS NULL OR _lives > _died)").select(*RUN_KEY, *values)


def fold(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The state of each run from all its events; see ``snapshot``."""
    return current(snapshot(events, columns))


def advance_watermark(
    jobs: DataFrame, state: DataFrame, order: Sequence[str] = ("round_time", "job_start_time", "dag_run_id")
) -> DataFrame:
    """Each job's watermark moved to the label of its last successful run, in run order."""
    last = (
        state.filter(F.col("status").isin(*schemas.SUCCEEDED) & F.col("ictrl_dt").isNotNull())
        .groupBy("job_nm").agg(F.max_by("ictrl_dt", F.struct(*order)).alias("_label"))
    )
    return jobs.join(last, "job_nm", "left").withColumn(
        "last_success_ictrl_dt", F.coalesce("_label", "last_success_ictrl_dt")
    ).drop("_label")
