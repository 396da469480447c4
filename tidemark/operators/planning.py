"""From configured jobs to the control dates each must run.

Inputs are ``jobs`` rows (see ``schemas.JOBS``) with a ``start_time`` and, optionally, a
``fixed_date``. Any number of jobs and start times goes through one plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import frequency as freq
from tidemark.functions import labels

# Day names in week order, the week starting on Sunday.
WEEK_DAYS = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]


def active_jobs(
    jobs: DataFrame, requested: DataFrame, by: str = "tasksgroup_nm"
) -> DataFrame:
    """Active jobs whose group (or name) is requested, all compared without case."""
    wanted = requested.select(F.lower(F.col(by)).alias("_wanted")).distinct()
    return jobs.filter(F.lower("active_flag") == "y").join(
        wanted, F.lower(jobs[by]) == F.col("_wanted"), "left_semi"
    )


def resolve_by_priority(
    names: DataFrame, tables: Mapping[str, DataFrame], key: str,
    priority: Sequence[str] = schemas.JOB_TYPE_PRIORITY,
) -> DataFrame:
    """The first table in priority order that holds each name, or a null type.

    Names are compared exactly. Each table shrinks to its distinct names map-side
    before the shuffle, so a name held by most rows of a table costs one row per task.
    """
    tagged = reduce(
        DataFrame.unionByName,
        [tables[kind].select(key).filter(F.col(key).isNotNull())
         .withColumn("_rank", F.lit(rank)) for rank, kind in enumerate(priority)],
    )
    best = tagged.groupBy(key).agg(F.min("_rank").alias("_rank"))
    kinds = F.array(*[F.lit(kind) for kind in priority])
    return (
        names.select(key).distinct().join(best, key, "left")
        .select(key, F.get(kinds, F.col("_rank")).alias("job_type"))
    )


PATTERN = labels.pattern_or_default("ictrl_dt_tgtfmt")
_INGEST_LIST = ", ".join(f"'{kind}'" for kind in schemas.INGEST_TYPES)
IS_INGEST = f"(job_type IN ({_INGEST_LIST}))"
# Ingest jobs always catch up step by step.
IS_SEQUENCE = f"({IS_INGEST} OR lower(coalesce(catchup_type, '')) = 'sequence')"


def with_master_ref_date(jobs: DataFrame) -> DataFrame:
    """``ref_ts``: the fixed date when given, else start time minus back_day steps."""
    back = freq.minus_steps("start_time", "frequency", "back_day")
    if "fixed_date" in jobs.columns:
        fixed = labels.parse("fixed_date", PATTERN)
        back = f"CASE WHEN coalesce(fixed_date, '') <> '' THEN {fixed} ELSE {back} END"
    return jobs.withColumn("ref_ts", F.expr(back))


def with_start_date(jobs: DataFrame) -> DataFrame:
    """``start_ts``: where catch-up begins, before any overlap is applied.

    The watermark if there is one (one step later when catching up in sequence), else
    the master date. Files flagged as call records always start at the master date.
    """
    watermark = labels.parse("last_success_ictrl_dt", PATTERN)
    return (
        jobs.withColumn("_watermark", F.expr(watermark))
        .withColumn("start_ts", F.expr(f"""CASE
            WHEN job_type = 'file' AND coalesce(cdr_flag, 'N') = 'Y' THEN ref_ts
            WHEN coalesce(last_success_ictrl_dt, '') = '' THEN ref_ts
            WHEN {IS_SEQUENCE} THEN {freq.plus_steps("_watermark", "frequency", "1")}
            ELSE _watermark END"""))
        .drop("_watermark")
    )


def with_loop_start(jobs: DataFrame) -> DataFrame:
    """``loop_ts``: first run of the loop; transform jobs begin their overlap earlier."""
    moved = freq.overlap_start("start_ts", "frequency", "overlap")
    return jobs.withColumn(
        "loop_ts", F.expr(f"CASE WHEN {IS_INGEST} THEN start_ts ELSE {moved} END")
    )


def plan_dates(jobs: DataFrame) -> DataFrame:
    """Reference, start and loop dates of every job, or the ``problem`` that forbids them."""
    dated = with_loop_start(with_start_date(with_master_ref_date(jobs)))
    return dated.withColumn("problem", F.expr(f"""CASE
        WHEN NOT {labels.is_supported(PATTERN)} THEN 'invalid_pattern'
        WHEN NOT ({freq.is_known("frequency")}) THEN 'invalid_frequency'
        WHEN ref_ts IS NULL THEN 'invalid_reference_date'
        WHEN start_ts IS NULL THEN 'invalid_watermark'
        WHEN loop_ts IS NULL THEN 'invalid_overlap' END"""))


def catchup_expand(dated: DataFrame) -> DataFrame:
    """One row per control date: the master date alone, or every step up to it.

    Unplannable jobs yield no row. The outer explode keeps Spark from adding a filter
    that would compute every date list twice.
    """
    sequence = freq.steps_between("loop_ts", "ref_ts", "step_minutes", "step_months")
    return (
        dated.withColumns({
            "step_minutes": F.expr(freq.step_minutes("frequency")),
            "step_months": F.expr(freq.step_months("frequency")),
        })
        .withColumn("run_ts", F.explode_outer(F.expr(f"""CASE
            WHEN problem IS NOT NULL THEN NULL
            WHEN {IS_SEQUENCE} THEN {sequence}
            ELSE array(ref_ts) END""")))
        .filter(F.col("run_ts").isNotNull())
        .drop("step_minutes", "step_months")
    )


def with_run_labels(runs: DataFrame) -> DataFrame:
    """Labels of each run: its date, the window it belongs to and its overlap start."""
    overlap = "CASE WHEN job_type = 'kafka' THEN '0' ELSE overlap END"
    overlapped = f"""CASE WHEN {IS_INGEST}
        THEN {freq.overlap_start("run_ts", "frequency", f"({overlap})")} ELSE loop_ts END"""
    named = {
        "ictrl_dt": "run_ts", "start_ictrl_dt": "loop_ts", "end_ictrl_dt": "ref_ts",
        "start_with_overlap": "_overlapped",
    }
    return (
        runs.withColumns({
            "_overlapped": F.expr(overlapped), "_pattern": F.expr(labels.spark_pattern(PATTERN))
        })
        .withColumns({name: F.expr(f"date_format({ts}, _pattern)") for name, ts in named.items()})
        .drop("_overlapped", "_pattern")
    )


def planned_runs(jobs: DataFrame) -> DataFrame:
    return with_run_labels(catchup_expand(plan_dates(jobs)))


# --- delay schedules -------------------------------------------------------------


def delay_base(mode: Column, start_job: Column, ref: Column) -> Column:
    """First delay day: a weekday of the reference week, or a day of the month."""
    first_sunday = F.date_sub(ref, F.dayofweek(ref) - 1)
    weekday = F.coalesce(
        *[F.when(F.lower(start_job).contains(day), F.lit(index))
          for index, day in enumerate(WEEK_DAYS)],
        F.lit(-1),
    )
    day = start_job.try_cast("int")
    this_month = F.try_make_timestamp_ntz(
        F.year(ref), F.month(ref), day, F.lit(0), F.lit(0), F.lit(0)
    ).cast("date")
    in_month = F.when(
        day > F.day(ref), F.add_months(this_month, -1)
    ).otherwise(this_month)
    return (
        F.when(F.lower(mode) == "week", F.date_add(first_sunday, weekday))
        .when(F.lower(mode) == "month", in_month)
    )


def delay_schedule(requests: DataFrame, delays: DataFrame) -> DataFrame:
    """Days on which a delayed ingestion may run; ``last_day`` is ``-`` without any.

    ``requests`` holds ``job_nm`` and ``ref_date``. A delay row counts only for job type
    ingestion with a flag other than n; a null flag drops it.
    """
    usable = schemas.conform(delays, schemas.DELAYS).filter(
        (F.lower("job_type") == "ingestion") & (F.lower("flag") != "n")
    ).select("job_nm", "date_start_job", "total_delay", "mode")
    base = delay_base(F.col("mode"), F.col("date_start_job"), F.col("ref_date"))
    total = F.col("total_delay").try_cast("int")
    offsets = F.when(total > 0, F.sequence(F.lit(0), total - 1)).otherwise(
        F.array().cast("array<int>")
    )
    days = F.transform(offsets, lambda i: F.date_format(F.date_add(base, i), "yyyy-MM-dd"))
    known = F.when(base.isNotNull(), days).otherwise(F.array().cast("array<string>"))
    return (
        requests.join(usable, "job_nm", "left")
        .withColumn("delay_days", known)
        .withColumn(
            "last_day", F.coalesce(F.try_element_at("delay_days", F.lit(-1)), F.lit("-"))
        )
        .select(*requests.columns, "mode", "delay_days", "last_day")
    )


def delay_status(schedule: DataFrame, log: DataFrame) -> DataFrame:
    """What the schedule says about the reference day.

    Already done when a success started on the previous or the current day and the day
    is scheduled; not a day for the job when the day is not scheduled; ``-`` otherwise.
    """
    succeeded = (
        log.filter(F.col("status").isin(*schemas.SUCCEEDED))
        .select("job_nm", F.to_date("job_start_time").alias("_day"))
        .distinct()
    )
    reach = succeeded.select(
        "job_nm", F.explode(F.array("_day", F.date_add("_day", 1))).alias("ref_date")
    ).distinct().withColumn("_done", F.lit(True))
    today = F.date_format("ref_date", "yyyy-MM-dd")
    scheduled = F.array_contains("delay_days", today)
    return (
        schedule.join(reach, ["job_nm", "ref_date"], "left")
        .withColumn(
            "delay_status",
            F.when(F.size("delay_days") == 0, "-")
            .when(~scheduled, "Not a Date to do this job")
            .when(F.col("_done"), "Job Has already Done")
            .otherwise("-"),
        )
        .drop("_done")
    )
