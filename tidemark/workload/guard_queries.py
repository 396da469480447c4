"""Duplicate-run guards with every logged run as a candidate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import guards
from tidemark.workload import views
from tidemark.workload.oracle_views import with_views


def guard_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order runs; every seventh customer's run has no label yet, odd customers no error."""
    return views.order_log(spark, sf_dir).select(
        "job_nm", "tasksgroup_nm", "dag_run_id", "job_start_time", "status",
        F.when(F.col("o_custkey") % 7 != 0, F.col("ictrl_dt")).alias("ictrl_dt"),
        # jobs are started in rounds of one minute
        F.date_trunc("minute", "round_time").cast("timestamp_ntz").alias("round_time"),
        F.when(F.col("o_custkey") % 2 == 1, "-").otherwise("late").alias("err_msg"),
    )


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run that has a label, its job name in lower case."""
    return guard_log(spark, sf_dir).filter("ictrl_dt IS NOT NULL").select(
        F.lower("job_nm").alias("job_nm"), "tasksgroup_nm", "round_time", "dag_run_id", "ictrl_dt"
    )


def _shown(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        "dag_run_id", "job_nm", F.date_format("round_time", "yyyy-MM-dd HH:mm").alias("round_time"),
        *columns,
    )


def guard_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each run looks at its own label and the day before."""
    log = guard_log(spark, sf_dir)
    day = F.to_date(F.col("ictrl_dt"), "yyyyMMdd")
    candidates = log.filter("ictrl_dt IS NOT NULL").select(
        "job_nm", "tasksgroup_nm", "round_time", "dag_run_id",
        F.array("ictrl_dt", F.date_format(F.date_sub(day, 1), "yyyyMMdd")).alias("labels"),
        F.col("job_start_time").alias("now"),
    )
    return _shown(guards.blocked_transform(candidates, log))


def _others(df: DataFrame) -> DataFrame:
    return _shown(
        df.withColumn("other_round", F.date_format("other_round", "yyyy-MM-dd HH:mm")),
        "other_run", "other_round",
    )


def guard_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = guard_log(spark, sf_dir)
    return _others(guards.blocked_ingest(_candidates(spark, sf_dir), log))


def guard_ingest_cdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = guard_log(spark, sf_dir)
    return _others(guards.blocked_ingest(_candidates(spark, sf_dir), log, any_label=True))


def guard_null_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = guard_log(spark, sf_dir)
    return _shown(guards.blocked_null_label(_candidates(spark, sf_dir), log))


def guard_succeeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = guard_log(spark, sf_dir)
    candidates = _candidates(spark, sf_dir)
    dropped = guards.already_succeeded(candidates, log).withColumn("runs", F.lit(False))
    kept = guards.without_succeeded(candidates, log).withColumn("runs", F.lit(True))
    return _shown(dropped.unionByName(kept), "runs")


def guard_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = guard_log(spark, sf_dir)
    candidates = _candidates(spark, sf_dir)
    events = guards.outcome_events(
        guards.blocked_ingest(candidates, log), guards.blocked_null_label(candidates, log)
    )
    by_null = F.col("err_msg").contains("ictrl_dt NULL")
    return _shown(
        events.withColumn("err_msg", F.when(by_null, F.substring_index("err_msg", " ->", 1))
                          .otherwise(F.col("err_msg"))),
        "status", "duration", "row_cnt", "err_msg",
    )


QUERIES = {
    "guard_transform": guard_transform,
    "guard_ingest": guard_ingest,
    "guard_ingest_cdr": guard_ingest_cdr,
    "guard_null_label": guard_null_label,
    "guard_succeeded": guard_succeeded,
    "guard_outcome": guard_outcome,
}

_LOG = """WITH log AS (
      SELECT l.job_nm, l.tasksgroup_nm, l.dag_run_id, l.job_start_time, l.status,
        CASE WHEN o.o_custkey % 7 <> 0 THEN l.ictrl_dt END AS ictrl_dt,
        date_trunc('minute', l.round_time) AS round_time,
        CASE WHEN o.o_custkey % 2 = 1 THEN '-' ELSE 'late' END AS err_msg
      FROM order_log l JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = l.dag_run_id
    ), cand AS (SELECT * REPLACE (lower(job_nm) AS job_nm) FROM log WHERE ictrl_dt IS NOT NULL) """
_ROUND = "strftime(c.round_time, '%Y-%m-%d %H:%M') AS round_time"


def _newest_other(same_label: str) -> str:
    return f""", pairs AS (
      SELECT c.*, l.dag_run_id AS other_run, l.round_time AS other_round,
        row_number() OVER (PARTITION BY c.dag_run_id ORDER BY l.round_time DESC, l.dag_run_id DESC) AS rn
      FROM cand c JOIN log l ON lower(l.job_nm) = c.job_nm AND l.tasksgroup_nm = c.tasksgroup_nm
        AND l.status = 'RUNNING' AND l.round_time <> c.round_time AND {same_label}
    ), label_block AS (
      SELECT * FROM pairs WHERE rn = 1 AND CAST(other_round AS DATE) = CAST(round_time AS DATE)
    ) """


_NULL_HIT = """EXISTS (SELECT 1 FROM log l WHERE lower(l.job_nm) = c.job_nm
      AND l.tasksgroup_nm = c.tasksgroup_nm AND l.status = 'RUNNING' AND l.ictrl_dt IS NULL
      AND l.round_time >= c.round_time - INTERVAL 3 HOUR AND l.round_time < c.round_time)"""
_OTHERS = f"""SELECT dag_run_id, job_nm, {_ROUND}, other_run,
      strftime(other_round, '%Y-%m-%d %H:%M') AS other_round FROM label_block c"""

ORACLES = {
    "guard_transform": with_views("order_log", _LOG + f"""
      SELECT DISTINCT c.dag_run_id, c.job_nm, {_ROUND} FROM log c JOIN log l ON l.job_nm = c.job_nm
        AND l.status = 'RUNNING' AND l.dag_run_id <> c.dag_run_id AND l.round_time <> c.round_time
        AND l.job_start_time >= c.job_start_time - INTERVAL 3 HOUR
        AND l.ictrl_dt IN (c.ictrl_dt,
          strftime(strptime(c.ictrl_dt, '%Y%m%d') - INTERVAL 1 DAY, '%Y%m%d'))
      WHERE c.ictrl_dt IS NOT NULL"""),
    "guard_ingest": with_views(
        "order_log", _LOG + _newest_other("l.ictrl_dt = c.ictrl_dt") + _OTHERS),
    "guard_ingest_cdr": with_views(
        "order_log", _LOG + _newest_other("l.ictrl_dt IS NOT NULL") + _OTHERS),
    "guard_null_label": with_views(
        "order_log", _LOG + f"SELECT dag_run_id, job_nm, {_ROUND} FROM cand c WHERE {_NULL_HIT}"),
    "guard_succeeded": with_views("order_log", _LOG + f"""SELECT dag_run_id, job_nm, {_ROUND},
      NOT EXISTS (SELECT 1 FROM log l WHERE lower(l.job_nm) = c.job_nm
        AND l.tasksgroup_nm = c.tasksgroup_nm AND l.ictrl_dt = c.ictrl_dt
        AND l.status = 'SUCCEED' AND l.err_msg = '-') AS runs FROM cand c"""),
    "guard_outcome": with_views("order_log", _LOG + _newest_other("l.ictrl_dt = c.ictrl_dt") + f"""
      SELECT dag_run_id, job_nm, {_ROUND}, 'FAILED' AS status, '00:00:00' AS duration,
        CAST(0 AS BIGINT) AS row_cnt,
        'DropDuplicatesJobError: Found Status RUNNING Job on ictrl_dt: ' || ictrl_dt ||
          ' Running ON -> dag_run_id: ' || other_run || ' round_time: ' ||
          strftime(other_round, '%Y-%m-%d %H:%M:%S') AS err_msg
      FROM label_block c
      UNION ALL
      SELECT dag_run_id, job_nm, {_ROUND}, 'FAILED', '00:00:00', 0,
        'DropDuplicatesJobError: Found Status RUNNING round_time under 3 with ictrl_dt NULL : '
          || 'Running ON'
      FROM cand c WHERE {_NULL_HIT} AND dag_run_id NOT IN (SELECT dag_run_id FROM label_block)"""),
}
