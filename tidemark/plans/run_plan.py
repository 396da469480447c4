"""From configured jobs to the next watermark: plan, check, guard, load, validate, record."""

from __future__ import annotations

import ast
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import audit, backlog, guards, loads, planning, readiness, validation
from tidemark.session import fresh_path, materialize, materialize_counted


def planned(jobs: DataFrame) -> DataFrame:
    """The runs of all jobs, worked out once for the checks and the rollup."""
    return materialize(planning.planned_runs(jobs), "runs")


def run_readiness(
    runs: DataFrame, dependencies: DataFrame, log: DataFrame, raw: DataFrame | readiness.RawTables | None = None,
    completions: DataFrame | None = None,
) -> DataFrame:
    """Planned runs with ``ready`` and the prerequisites each still waits for.

    A job has one start time here, so its run date names the run.
    """
    verdicts = readiness.readiness(
        readiness.checks_for_runs(runs, dependencies), log, raw, completions
    )
    return readiness.job_rollup(runs.withColumn("ref_ts", F.col("run_ts")), verdicts)


# --- guards -------------------------------------------------------------------------------


def _candidates(runs: DataFrame) -> DataFrame:
    """Ready runs; a run is about its own label, now, unless its row says otherwise."""
    ready = runs.filter("ready")
    if "labels" not in ready.columns:
        ready = ready.withColumn("labels", F.array("ictrl_dt"))
    return ready if "now" in ready.columns else ready.withColumn("now", F.col("round_time"))


def blocked(runs: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Blocked transform runs, ingest runs blocked on a label, and on a run without one.

    Each kind of job has its own guard; files of call records are blocked by any label.
    """
    ready = _candidates(runs)
    ingest = ready.filter(planning.IS_INGEST)
    call_records = F.expr("job_type = 'file' AND coalesce(cdr_flag, 'N') = 'Y'")
    by_label = guards.blocked_ingest(ingest.filter(~call_records), log).unionByName(
        guards.blocked_ingest(ingest.filter(call_records), log, any_label=True)
    )
    transform = ready.filter(f"NOT {planning.IS_INGEST}")
    return guards.blocked_transform(transform, log), by_label, guards.blocked_null_label(ingest, log)


#: What stands in the way of a run: nothing, an earlier success, a guard, a prerequisite.
FREE, DONE, BLOCKED, WAITING = "free", "done", "blocked", "waiting"
# Fixed value: the text of a run whose prerequisites are not there.
NOT_READY = ("The dependency job check failed because this job = ", " is not finished")


def judged(runs: DataFrame, log: DataFrame) -> DataFrame:
    """Runs with ``verdict`` and, where one stands in its way, the ``reason`` it is logged with.

    ``runs`` are planned runs with ``ready``, ``not_ready`` and the candidate columns of ``guards``; a run is
    named by its job and run id. The guards are asked once and their few answers joined to the runs.
    """
    transform, by_label, by_null = blocked(runs, log)
    key, run = ["job_nm", "dag_run_id"], ["job_nm", "dag_run_id", "ictrl_dt"]
    by_rounds = guards.outcome_events(by_label, by_null).groupBy(*run).agg(F.min("err_msg").alias("_held"))
    by_runs = transform.select(*key).distinct().withColumn("_busy", F.concat(F.lit(guards.BLOCKED), "job_nm"))
    done = guards.already_succeeded(runs, log).select(*run).distinct().withColumn("_done", F.lit(True))
    held = F.coalesce("_held", "_busy")
    verdict = F.when(F.col("_done"), DONE).when(~F.col("ready"), WAITING).when(held.isNotNull(), BLOCKED).otherwise(FREE)
    waits = F.concat(F.lit(NOT_READY[0]), F.array_join("not_ready", ","), F.lit(NOT_READY[1]))
    reason = F.when(F.col("verdict") == WAITING, waits).when(F.col("verdict") == BLOCKED, held)
    return (
        runs.join(by_rounds, run, "left").join(by_runs, key, "left").join(done, run, "left")
        .withColumn("verdict", verdict).withColumn("reason", reason).drop("_held", "_busy", "_done")
    )


def startable(runs: DataFrame, log: DataFrame) -> DataFrame:
    """Ready runs that no guard blocks and that have not already succeeded, whatever came of those before them."""
    if "not_ready" not in runs.columns:
        runs = runs.withColumn("not_ready", F.array().cast("array<string>"))
    return judged(runs, log).filter(F.col("verdict") == FREE).drop("verdict", "reason")


def in_order(runs: DataFrame) -> DataFrame:
    """Judged runs with ``stop_ts``: the job's first date, by time, that waits or is blocked; null if none.

    A job's dates run one after another and end there. One aggregated row a job: its dates are not sorted.
    """
    stops = runs.filter(F.col("verdict").isin(WAITING, BLOCKED)).groupBy("job_nm").agg(F.min("run_ts").alias("stop_ts"))
    return runs.join(stops, "job_nm", "left")


# --- one composed run ------------------------------------------------------------------------


STATE = ["ictrl_dt", "status", "err_msg", "row_cnt", "job_start_time"]


@dataclass(frozen=True)
class Outcome:
    """What a run leaves: new audit events, the state they and the old ones add up to, the jobs.

    ``snapshot`` is that state in the form the next run adds its own events to, without reading the old ones.
    """

    events: DataFrame
    state: DataFrame
    jobs: DataFrame
    snapshot: DataFrame


def names(text: str | None) -> list[str]:
    """A configured column list: ``['a', 'b']`` or a single name."""
    text = (text or "").strip()
    if text.startswith("["):
        return [str(name) for name in ast.literal_eval(text)]
    return [text] if text else []


@dataclass(frozen=True)
class Loaded:
    """How far a job came: the run time of its last loaded date, and of the date it failed on."""

    job_nm: str
    loaded_until: datetime | None = None
    failed_at: datetime | None = None
    err_msg: str | None = None


_LOADED = "job_nm string, loaded_until timestamp_ntz, failed_at timestamp_ntz, err_msg string"
_COUNTS = "job_nm string, run_ts timestamp_ntz, row_cnt bigint"


def _described(problem: Exception) -> str:
    return f"{type(problem).__name__}: {(str(problem).splitlines() or [''])[0]}"


def _invalid(spark: SparkSession, table: str, rules: Sequence[validation.Rule]) -> str | None:
    """The rules that the table breaks."""
    if not rules:
        return None
    found = validation.evaluate(rules, {table: spark.table(table)}).filter("NOT is_valid")
    wrong = [row["rule_id"] for row in found.orderBy("rule_id").collect()]
    return f"validation failed: {', '.join(wrong)}" if wrong else None


def load_job(
    job: Row, runs: DataFrame, rows: DataFrame, rules: Sequence[validation.Rule], first: datetime, last: datetime
) -> Loaded:
    """Load one job's dates in order, as its row says, up to the first that fails.

    ``runs`` (run_ts) are the dates, ``rows`` their staged rows with ``run_ts``. Several dates
    are folded into one load where that leaves the same table (``backlog.fold``). Rules are about the table as
    each date leaves it, so a job with rules loads date by date, and so does one whose folded load fails: the dates
    before the failing one then stay loaded.
    """
    table = f"{job['schema_nm']}.{job['table_nm']}" if job["schema_nm"] else job["table_nm"]
    own = [rule for rule in rules if rule.table == table]
    how = {"partition_by": names(job["partition_column"]), "keys": names(job["unique_key"]),
           "condition": job["update_condition"], "update_columns": names(job["update_column"]) or None}
    if first != last and not own:
        try:
            folded = backlog.fold(rows, "run_ts", last, job["load_type"], **how)
            if folded is not None:
                loads.load(folded, table, job["load_type"], **how)
                return Loaded(job["job_nm"], last)
        except Exception:  # which date it is shows below
            pass
    until = None
    # a job's due dates, of which there are as many as loads
    for date in [first] if first == last else [r["run_ts"] for r in runs.select("run_ts").distinct().orderBy("run_ts").collect()]:
        try:
            of_date = rows.filter(F.col("run_ts") == F.lit(date).cast("timestamp_ntz")).drop("run_ts")
            loads.load(of_date, table, job["load_type"], **how)
            problem = _invalid(rows.sparkSession, table, own)
        except Exception as failure:  # one job's failure is recorded and leaves the others running
            problem = _described(failure)
        if problem:
            return Loaded(job["job_nm"], until, date, problem)
        until = date
    return Loaded(job["job_nm"], until)


def _load_all(
    jobs: DataFrame, starting: DataFrame, staged: Mapping[str, DataFrame], rules: Sequence[validation.Rule], parallel: int
) -> tuple[DataFrame, DataFrame]:
    """How far each job came, and the staged rows of each run (job_nm, run_ts, row_cnt).

    Each job has a table of its own; ``parallel`` jobs load at a time. The driver holds a row a job.
    """
    spark = jobs.sparkSession
    due = starting.groupBy("job_nm").agg(F.min("run_ts").alias("first"), F.max("run_ts").alias("last"))
    counts = fresh_path(spark, "staged-counts")
    counted_rows: list[tuple] = []

    def one(numbered: tuple[int, Row]) -> Loaded:
        number, job = numbered
        try:
            runs = starting.filter(F.col("job_nm") == job["job_nm"]).select("ictrl_dt", "run_ts")
            rows = staged[job["job_nm"]]
            rows, n = materialize_counted(rows.join(runs, "ictrl_dt").select(*rows.columns, "run_ts"), "staged")
            if job["first"] == job["last"]:  # one date: what the write counted
                counted_rows.append((job["job_nm"], job["first"], n))
            else:
                per_run = rows.groupBy("run_ts").agg(F.count("*").alias("row_cnt"))
                per_run.select(F.lit(job["job_nm"]).alias("job_nm"), "run_ts", "row_cnt").write.parquet(f"{counts}/{number}")
            return load_job(job, runs, rows, rules, job["first"], job["last"])
        except Exception as problem:  # nothing of the job could be staged
            return Loaded(job["job_nm"], None, job["first"], _described(problem))

    started = jobs.join(due, "job_nm").orderBy("job_nm").collect()
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(one), enumerate(started)))
    counted = spark.createDataFrame(counted_rows, _COUNTS)
    if any(job["first"] != job["last"] for job in started):
        spark.createDataFrame([], _COUNTS).write.parquet(f"{counts}/none")
        counted = counted.unionByName(spark.read.schema(_COUNTS).parquet(f"{counts}/*"))
    return spark.createDataFrame([astuple(r) for r in results], _LOADED), counted


def execute(
    jobs: DataFrame, dependencies: DataFrame, log: DataFrame, events: DataFrame | None,
    staged: Mapping[str, DataFrame], rules: Sequence[validation.Rule], dag_run_id: str,
    raw: DataFrame | readiness.RawTables | None = None, completions: DataFrame | None = None,
    snapshot: DataFrame | None = None, parallel: int = 4,
) -> Outcome:
    """Everything that is due: jobs to new watermarks.

    ``jobs`` are ``schemas.JOBS`` rows with a ``start_time``, a row a job; ``log`` is the audit log that
    readiness and guards ask; ``events`` the audit events so far, or ``snapshot`` what an earlier run folded them to
    (then they are not read); ``staged`` the staged rows of each job, with their ``ictrl_dt``.

    A job's dates run in the order of time and end at the first that waits for a prerequisite, is blocked by a
    guard, or fails to load or to satisfy its rules; that date leaves a failed run, later ones leave nothing and are
    due again. Dates that already succeeded are passed over. The watermark is the last date before the end. Dates,
    checks, guards and events cover all runs in one plan each; loading goes job by job, as each has a table
    of its own, and a job that fails leaves the others alone.
    """
    given = jobs.columns
    log = schemas.conform(log, schemas.AUDIT_LOG)
    jobs = schemas.conform(jobs, schemas.JOBS).join(jobs.select("job_nm", "start_time"), "job_nm")
    due = run_readiness(planned(jobs), schemas.conform(dependencies, schemas.DEPENDENCIES), log, raw, completions)
    due = materialize(due.withColumns({
        "log_kind": F.when(F.expr(planning.IS_INGEST), "ingest").otherwise("trans"),
        "round_time": F.col("start_time"), "job_start_time": F.col("start_time"),
        # a job's dates are runs of their own; labels of several may be the same
        "dag_run_id": F.concat_ws("/", F.lit(dag_run_id), F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")),
    }), "due")
    plan = materialize(in_order(judged(due, log)), "judged")
    before = plan.filter("stop_ts IS NULL OR run_ts < stop_ts")
    starting = before.filter(F.col("verdict") == FREE)
    came, counted = _load_all(jobs, starting, staged, rules, parallel)
    reached = before.join(came, "job_nm", "left").filter("failed_at IS NULL OR run_ts <= failed_at")
    reached = materialize(reached.join(counted, ["job_nm", "run_ts"], "left"), "reached")

    ran = reached.filter(F.col("verdict") == FREE)
    failed = F.coalesce(F.col("run_ts") == F.col("failed_at"), F.lit(False))
    closed = audit.completion(ran.withColumns({
        "err_msg": F.when(failed, F.col("err_msg")), "row_cnt": F.coalesce("row_cnt", F.lit(0)),
        "status": F.when(failed, schemas.FAILED).otherwise("SUCCESS"),
        "log_url": F.lit(""), "job_end_time": F.col("start_time"),
    }))
    # the date a job ends at, unless a load failed before it
    ends = plan.filter("run_ts = stop_ts").join(came.filter("failed_at IS NOT NULL"), "job_nm", "left_anti")
    passed = reached.filter(F.col("verdict") == DONE)
    new = materialize(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        audit.start_trans(ran.filter(f"NOT {planning.IS_INGEST}")), audit.start_ingest(ran.filter(planning.IS_INGEST)),
        closed, guards.refused_events(ends), audit.deletion(passed, F.col("round_time")),
    ]), "events")
    added = audit.snapshot(new, STATE)
    if snapshot is None:
        snapshot = audit.snapshot(new if events is None else events.unionByName(new, allowMissingColumns=True), STATE)
    else:
        snapshot = audit.combine(snapshot, added)
    snapshot = materialize(snapshot, "state")
    moved = audit.advance_watermark(
        jobs, reached.filter(~failed).withColumn("status", F.lit("SUCCESS")), order=("run_ts",))
    return Outcome(new, audit.current(snapshot), moved.select(*given), snapshot)
