"""Validation rules, run results, audit events and the state folded from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import audit, planning, validation
from tidemark.operators.validation import Rule
from tidemark.workload import control, views
from tidemark.workload.oracle_views import fmt, with_views
from tidemark.workload.planning_queries import PLAN_VIEWS, PLANNED

_SECOND = "yyyy-MM-dd HH:mm:ss"
RULES = [
    Rule(rule_id, table, calc, tuple(columns), expect, operation, sql or "", tuple(arguments or ()), margin)
    for rule_id, table, calc, columns, expect, operation, sql, arguments, margin in control.RULES
]


# --- validation ------------------------------------------------------------------------


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = ("lineitem", "orders")
    single = views.table(spark, sf_dir, "orders").agg(F.count("*").alias("n"), F.lit(1).alias("one"))
    return {**{n: views.table(spark, sf_dir, n) for n in names}, "order_count": single}


def _validated(*rule_ids: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        chosen = [r for r in RULES if r.rule_id in rule_ids]
        return validation.evaluate(chosen, _tables(spark, sf_dir)).select(
            "rule_id", F.round(F.coalesce("value", F.lit(-1)), 4).alias("value"), "is_valid", "reason"
        )

    return query


def validate_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item's price against its order's part of it, with every operation."""
    items = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").alias("value"), (F.lit(25.0) - F.col("l_linenumber")).alias("expect"),
        F.explode(F.array(*map(F.lit, [">=", "<=", "==", ">", "<", "~"]))).alias("operation"),
        (F.col("l_discount") * 1000).alias("margin"),
    )
    verdict = validation.within_tolerance(
        F.col("value"), F.col("expect"), F.col("operation"), F.round("margin", 0)
    )
    return items.groupBy("operation", "l_linenumber").agg(
        F.count_if(verdict).alias("passed"), F.count_if(~verdict).alias("failed"),
        F.count_if(verdict.isNull()).alias("refused"),
    )


def group_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as runs of their orders."""
    items = views.order_log(spark, sf_dir).select(F.col("o_custkey").alias("run_id"), "status")
    return validation.group_result(items)


# --- audit ------------------------------------------------------------------------------


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = planning.planned_runs(views.job_starts(spark, sf_dir))
    return runs.select(
        "*", F.lit("grp").alias("tasksgroup_nm"), F.lit("mart").alias("schema_nm"),
        F.concat(F.lit("tbl_"), "job_nm").alias("table_nm"), F.lit("append").alias("load_type"),
        F.lit("batch").alias("ingestion_type"),
        F.concat(F.lit("run_"), F.date_format("start_time", "yyyyMMddHH")).alias("dag_run_id"),
        F.col("start_time").alias("round_time"), F.col("start_time").alias("job_start_time"),
    )


def _started(ingest: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        planned = _runs(spark, sf_dir)
        runs = planned.filter(planning.IS_INGEST if ingest else f"NOT {planning.IS_INGEST}")
        events = audit.start_ingest(runs) if ingest else audit.start_trans(runs)
        shown = events.select(
            "log_kind", "job_nm", "dag_run_id", F.date_format("round_time", _SECOND).alias("round_time"),
            "table_nm", "ictrl_dt", "start_ictrl_dt", "end_ictrl_dt", "pattern_ictrl_dt", "status",
            *(["ingestion_type"] if ingest else []),
        )
        return shown

    return query


def _order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = views.order_log(spark, sf_dir)
    return log.withColumns({
        "final_status": F.when(F.col("status") == "SUCCEED", "SUCCESS").otherwise(F.col("status")),
        "ictrl_dt_tgtfmt": F.lit("%Y%m%d"), "start_ictrl_dt": F.col("ictrl_dt"),
        "end_ictrl_dt": F.col("ictrl_dt"), "load_type": F.lit("append"),
        "ingestion_type": F.lit("batch"),
        "err_msg": F.when(F.col("status") == "FAILED", F.concat(F.lit("it's late: "), "job_nm")),
        "log_url": F.concat(F.lit("log/"), "dag_run_id"),
    })


def audit_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three steps per order run; each starts when the one before it ends."""
    start, end = F.col("job_start_time"), F.col("job_end_time")
    third = start + (end - start) / 3
    half = start + (end - start) / 2
    times = F.array(*[
        F.struct(a.alias("start"), b.alias("end"))
        for a, b in ((start, third), (third, half), (half, end))
    ])
    detail = audit.steps(_order_runs(spark, sf_dir).withColumn("step_times", times))
    announced = audit.next_steps(detail).select("dag_run_id", "step_seq", F.lit("next").alias("kind"),
                                                F.lit("").alias("duration"))
    done = detail.select("dag_run_id", "step_seq", F.lit("done").alias("kind"), "duration")
    return done.unionByName(announced)


def audit_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = audit.completion(
        _order_runs(spark, sf_dir).withColumn("status", F.col("final_status"))
    )
    return closed.select(
        "dag_run_id", "status", "err_msg", F.coalesce("row_cnt", F.lit(-1)).alias("row_cnt"),
        "log_url", "duration",
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, completion (of all that do not still run) and deletion (of late failures)."""
    runs = _order_runs(spark, sf_dir)
    started = audit.start_trans(runs.filter("log_kind = 'trans'")).unionByName(
        audit.start_ingest(runs.filter("log_kind = 'ingest'")), allowMissingColumns=True
    )
    closed = audit.completion(runs.filter("status <> 'RUNNING'").withColumn("status", F.col("final_status")))
    deleted = audit.deletion(
        runs.filter("status = 'FAILED' AND row_cnt = 0"), F.col("job_end_time") + F.expr("INTERVAL 1 DAY"))
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [started, closed, deleted]
    )


_STATE = ["ictrl_dt", "job_start_time", "status", "err_msg", "row_cnt", "duration"]


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.fold(_events(spark, sf_dir), _STATE)


def audit_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(spark, sf_dir).select(
        "log_kind", "dag_run_id", "job_nm", "ictrl_dt", "status",
        F.coalesce("err_msg", F.lit("")).alias("err_msg"),
        F.coalesce("duration", F.lit("")).alias("duration"),
        F.coalesce("row_cnt", F.lit(-1)).alias("row_cnt"),
    )


def audit_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs whose deletion removed them from the state."""
    logged = views.order_log(spark, sf_dir).select("dag_run_id", "job_nm")
    return logged.join(_state(spark, sf_dir), "dag_run_id", "left_anti")


def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermarks of the priorities and groups, from the folded runs."""
    jobs = views.order_log(spark, sf_dir).select(
        F.concat_ws("/", "job_nm", "tasksgroup_nm").alias("job_nm"),
        F.lit("19900101").alias("last_success_ictrl_dt"),
    ).distinct()
    state = _state(spark, sf_dir).withColumn("job_nm", F.concat_ws("/", "job_nm", "tasksgroup_nm"))
    idle = jobs.withColumn("job_nm", F.concat(F.lit("idle "), "job_nm"))
    return audit.advance_watermark(jobs.unionByName(idle), state)


_GROUPS = {
    "validate_sum": ("sum_qty", "sum_loss"),
    "validate_min": ("min_ship", "min_qty"),
    "validate_max": ("max_tax", "max_line"),
    "validate_avg": ("avg_qty", "avg_price"),
    "validate_scalar": ("one_value", "many_rows"),
    "validate_sql_calc": ("calc_net", "calc_max"),
    "validate_rules": tuple(r.rule_id for r in RULES),
}
QUERIES = {
    **{name: _validated(*ids) for name, ids in _GROUPS.items()},
    "validate_tolerance": validate_tolerance,
    "group_result": group_result,
    "audit_start_trans": _started(ingest=False),
    "audit_start_ingest": _started(ingest=True),
    "audit_steps": audit_steps,
    "audit_complete": audit_complete,
    "audit_fold": audit_fold,
    "audit_delete": audit_delete,
    "watermark_advance": watermark_advance,
}

# --- the same in SQL -----------------------------------------------------------------

# rule -> its value and its condition, each written out by hand
_CHECKS = {
    "sum_qty": ("sum(l_quantity) FROM lineitem", "v >= 1.5e6 * 0.95"),
    "sum_loss": ("-sum(l_linenumber) FROM lineitem", "v BETWEEN -264000 AND -216000"),
    "min_ship": ("min(l_discount) + 0 FROM lineitem", "v = 0"),
    "min_qty": ("min(l_quantity) FROM lineitem", "v > 1"),
    "max_tax": ("max(l_tax) FROM lineitem", "v <= 0.08"),
    "max_line": ("max(l_linenumber) FROM lineitem", "v < 10.5"),
    "avg_qty": ("avg(l_quantity) FROM lineitem", "v BETWEEN 24 AND 26"),
    "avg_price": ("avg(o_totalprice) FROM orders", "v < 1010"),
    "one_value": ("count(*) FROM orders", "v >= 100"),
    "calc_net": ("sum(l_quantity * (100 - l_discount * 100) / 100) FROM lineitem", "v >= 1"),
    "calc_max": ("max(o_orderkey) FROM orders", "v = 14999"),
}
_REFUSED = {
    "bad_agg": "unsupported aggregate: median",
    "many_rows": "needs exactly one row",
}


def _check_sql(rule_id: str) -> str:
    if rule_id in _REFUSED:
        return f"SELECT '{rule_id}' AS rule_id, -1.0::DOUBLE AS value, false AS is_valid, '{_REFUSED[rule_id]}' AS reason"
    if rule_id == "bad_op":
        return ("SELECT 'bad_op' AS rule_id, max(o_orderkey)::DOUBLE AS value, false AS is_valid, "
                "'unsupported operation: !=' AS reason FROM orders")
    value, condition = _CHECKS[rule_id]
    return (f"SELECT '{rule_id}' AS rule_id, round(v, 4) AS value, {condition} AS is_valid, "
            f"NULL::VARCHAR AS reason FROM (SELECT CAST({value.split(' FROM ')[0]} AS DOUBLE) AS v "
            f"FROM {value.split(' FROM ')[1]})")


def _start_sql(ingest: bool) -> str:
    kind = "job_type NOT IN ('transform', 'outbound')" if ingest else "job_type IN ('transform', 'outbound')"
    return with_views(PLAN_VIEWS, PLANNED + f"""
      SELECT '{'ingest' if ingest else 'trans'}' AS log_kind, job_nm,
        'run_' || strftime(start_time, '%Y%m%d%H') AS dag_run_id,
        strftime(start_time, '%Y-%m-%d %H:%M:%S') AS round_time, 'tbl_' || job_nm AS table_nm,
        {fmt('run_ts', 'ictrl_dt_tgtfmt')} AS ictrl_dt, {fmt('loop_ts', 'ictrl_dt_tgtfmt')} AS start_ictrl_dt,
        {fmt('ref_ts', 'ictrl_dt_tgtfmt')} AS end_ictrl_dt, ictrl_dt_tgtfmt AS pattern_ictrl_dt,
        'RUNNING' AS status{", 'batch' AS ingestion_type" if ingest else ""}
      FROM all_runs WHERE {kind}""")


def _took(seconds: str) -> str:
    return (f"printf('%02d:%02d:%02d', CAST(({seconds}) // 3600 AS INTEGER), "
            f"CAST((({seconds}) // 60) % 60 AS INTEGER), CAST(({seconds}) % 60 AS INTEGER))")


_SECS = "CAST(date_diff('second', job_start_time, job_end_time) AS BIGINT)"
_STATUS = "CASE status WHEN 'SUCCEED' THEN 'SUCCESS' ELSE status END"
_DELETED = "status = 'FAILED' AND row_cnt = 0"
ORACLES = {
    **{name: " UNION ALL ".join(_check_sql(i) for i in ids) for name, ids in _GROUPS.items()},
    "validate_tolerance": """WITH items AS (
        SELECT l_linenumber, l_quantity AS v, 25.0::DOUBLE - l_linenumber AS e,
          (25.0::DOUBLE - l_linenumber) * round(l_discount * 1000) / 100 AS slack FROM lineitem
      ), judged AS (
        SELECT '>=' AS operation, l_linenumber, v >= e - slack AS ok FROM items
        UNION ALL SELECT '<=', l_linenumber, v <= e + slack FROM items
        UNION ALL SELECT '==', l_linenumber, v BETWEEN e - slack AND e + slack FROM items
        UNION ALL SELECT '>', l_linenumber, v > e - slack FROM items
        UNION ALL SELECT '<', l_linenumber, v < e + slack FROM items
        UNION ALL SELECT '~', l_linenumber, NULL FROM items)
      SELECT operation, l_linenumber, count(*) FILTER (WHERE ok) AS passed,
        count(*) FILTER (WHERE NOT ok) AS failed, count(*) FILTER (WHERE ok IS NULL) AS refused
      FROM judged GROUP BY ALL""",
    "group_result": with_views("order_log", """WITH counted AS (
        SELECT o.o_custkey AS run_id, count(*) AS item_cnt,
          count(*) FILTER (WHERE l.status <> 'SUCCEED') AS error_cnt,
          count(*) FILTER (WHERE l.status = 'FAILED') AS failed,
          count(*) FILTER (WHERE l.status = 'RUNNING') AS running
        FROM order_log l JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = l.dag_run_id GROUP BY 1)
      SELECT run_id, item_cnt, error_cnt, CASE WHEN error_cnt = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
        CASE WHEN error_cnt = 0 THEN '' ELSE 'There is error on ' || error_cnt || ' of ' || item_cnt ||
          ' items: ' || concat_ws(', ', CASE WHEN failed > 0 THEN 'FAILED=' || failed END,
          CASE WHEN running > 0 THEN 'RUNNING=' || running END) END AS message
      FROM counted"""),
    "audit_start_trans": _start_sql(ingest=False),
    "audit_start_ingest": _start_sql(ingest=True),
    "audit_complete": with_views("order_log", f"""SELECT dag_run_id, {_STATUS} AS status,
        CASE WHEN status = 'FAILED' THEN 'it''s late: ' || job_nm ELSE '-' END AS err_msg,
        CASE WHEN log_kind = 'ingest' THEN -1 ELSE row_cnt END AS row_cnt,
        'log/' || dag_run_id AS log_url, {_took(_SECS)} AS duration FROM order_log"""),
    "audit_fold": with_views("order_log", f"""SELECT log_kind, dag_run_id, job_nm, ictrl_dt,
        {_STATUS} AS status, CASE status WHEN 'FAILED' THEN 'it''s late: ' || job_nm
          WHEN 'SUCCEED' THEN '-' ELSE '' END AS err_msg,
        CASE WHEN status = 'RUNNING' THEN '' ELSE {_took(_SECS)} END AS duration,
        CASE WHEN log_kind = 'ingest' OR status = 'RUNNING' THEN -1 ELSE row_cnt END AS row_cnt
      FROM order_log WHERE NOT ({_DELETED})"""),
    "audit_delete": with_views(
        "order_log", f"SELECT dag_run_id, job_nm FROM order_log WHERE {_DELETED}"),
    "audit_steps": with_views("order_log", f"""WITH cut AS (
        SELECT dag_run_id, {_SECS} AS s, epoch_us(job_start_time) % 1000000 AS us FROM order_log)
      SELECT dag_run_id, 'FW:2' AS step_seq, 'done' AS kind, {_took('s // 3')} AS duration FROM cut
      UNION ALL SELECT dag_run_id, 'FW:3', 'done', {_took('s // 2 - s // 3')} FROM cut
      UNION ALL SELECT dag_run_id, 'FW:4', 'done', {_took('s - s // 2')} FROM cut
      UNION ALL SELECT dag_run_id, unnest(['FW:3', 'FW:4']), 'next', '' FROM cut"""),
    "watermark_advance": with_views("order_log", """WITH last AS (
        SELECT job_nm || '/' || tasksgroup_nm AS job_nm, ictrl_dt, row_number() OVER (
          PARTITION BY job_nm, tasksgroup_nm ORDER BY round_time DESC, dag_run_id DESC) AS rn
        FROM order_log WHERE status = 'SUCCEED'),
      jobs AS (SELECT DISTINCT job_nm || '/' || tasksgroup_nm AS job_nm FROM order_log)
      SELECT j.job_nm, COALESCE(l.ictrl_dt, '19900101') AS last_success_ictrl_dt
      FROM jobs j LEFT JOIN last l ON l.job_nm = j.job_nm AND l.rn = 1
      UNION ALL SELECT 'idle ' || job_nm, '19900101' FROM jobs"""),
}
