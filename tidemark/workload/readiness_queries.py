"""Readiness queries: every generator and verdict over the whole backfill window."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import expected as exp
from tidemark.operators import readiness as rd
from tidemark.operators import loads, workflow
from tidemark.session import materialize
from tidemark.workload import control, views
from tidemark.workload.oracle_views import fmt, with_views


def show_verdicts(verdicts: DataFrame) -> DataFrame:
    return verdicts.select(
        "dep_id", F.date_format("ref_ts", "yyyy-MM-dd HH").alias("ref_date"), "ready",
        F.size("missing").cast("bigint").alias("missing_cnt"),
        F.array_join("missing", ",").alias("missing"), "reason",
    )


def verdicts(
    spark: SparkSession, sf_dir: str, which: str = "true", dates: DataFrame | None = None
) -> DataFrame:
    return rd.readiness(
        views.checks(spark, sf_dir, which, dates),
        views.audit_log(spark, sf_dir),
        views.raw_tables(spark, sf_dir),
    )


def _ready(which: str):
    return lambda spark, sf_dir: show_verdicts(verdicts(spark, sf_dir, which))


def _of(*kinds: str) -> str:
    return "frequency_check IN (" + ", ".join(f"'{k}'" for k in kinds) + ")"


_LOG, _RAW = "data_column IS NULL AND ", "data_column IS NOT NULL AND "
SELECTIONS = {
    "ready_daily": _of("daily"),
    "ready_weekly": _of("weekly"),
    "ready_cur_month": _of("cur_month"),
    "ready_prev_month": _of("prev_month"),
    "ready_eom": _of("eom"),
    "ready_day_n": _of("day-n"),
    "ready_hourly": _of("hourly"),
    "ready_quarter": _of("quarter"),
    "ready_mtd": _of("month_to_date"),
    "ready_ytd": _of("year_to_date"),
    "ready_htd": _of("hour_to_date"),
    "ready_daily_period": _of("daily_period"),
    "ready_date_range": _of("date_range"),
    "ready_date_in_range": _of("date_in_range"),
    "ready_max_date": _of("max_date"),
    "ready_24hours": _of("24hours"),
    "ready_every_n_hour": _of("every_n_hour"),
    "ready_unsupported": _of("hour_in_range", "weekly"),
    "verdict_latest": _LOG + _of(*exp.SINGLE),
    "verdict_missing": _LOG + _of(*exp.WINDOW),
    "verdict_tolerant": _of(*exp.TOLERANT),
    "verdict_max": _LOG + _of(*exp.NEWEST),
    "raw_present": _RAW + _of(*exp.SINGLE),
    "raw_missing": _RAW + _of(*exp.WINDOW),
    "raw_max": _RAW + _of(*exp.NEWEST),
    "log_or_raw": _of("daily", "quarter", "daily_period", "24hours", "max_date"),
}


def _ref_date():
    return F.date_format("ref_ts", "yyyy-MM-dd HH").alias("ref_date")


def dependency_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = views.job_starts(spark, sf_dir)
    return rd.dependency_fanout(starts, views.dependencies(spark)).select(
        "job_nm", F.date_format("start_time", "yyyy-MM-dd HH").alias("start_time"),
        "dep_id", "prerequisite_job_nm", "frequency_check",
    )


def log_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = views.checks(spark, sf_dir, _LOG + _of("date_range", "weekly", "24hours"))
    return rd.looked_up(checks, views.audit_log(spark, sf_dir)).select(
        "dep_id", _ref_date(), "route", "label",
        F.coalesce("best_rows", F.lit(-1)).alias("best_rows"),
        F.coalesce("latest_rows", F.lit(-1)).alias("latest_rows"),
    )


def two_log_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transform checks on both logs, with the verdict of each log beside the folded one."""
    routes = rd.verdicts_by_route(
        views.checks(spark, sf_dir, _TWO_LOGS), views.audit_log(spark, sf_dir)
    )
    return routes.groupBy("dep_id", _ref_date()).agg(
        F.bool_or(F.col("ready") & (F.col("route") == "trans")).alias("in_trans"),
        F.bool_or(F.col("ready") & (F.col("route") == "ingest")).alias("in_ingest"),
        F.bool_or("ready").alias("ready"),
    )


_TWO_LOGS = _LOG + "job_nm IN ('load_daily', 'load_weekly') AND " + _of("daily", "weekly", "hourly")


def job_ready_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: every job at every reference date, with the prerequisites it waits for."""
    dates = materialize(views.reference_dates(spark, sf_dir), "reference-dates")
    runs = views.jobs(spark).join(dates, "clock").select("job_nm", "ref_ts")
    return rd.job_rollup(runs, verdicts(spark, sf_dir, dates=dates)).select(
        "job_nm", _ref_date(), "ready", F.array_join("not_ready", ",").alias("not_ready")
    )


def log_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each priority's newest run of each month, from a log that is a table partitioned by label."""
    month = F.date_trunc("month", "job_start_time").cast("timestamp_ntz")
    log = views.order_log(spark, sf_dir).withColumn("ictrl_dt", F.date_format(month, "yyyyMMdd"))
    months = views.table(spark, sf_dir, "orders").select(
        "o_orderpriority", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("ref_ts")).distinct()
    checks = months.select(
        F.col("o_orderpriority").alias("dep_id"), "ref_ts", F.lit("down").alias("job_nm"), F.lit("transform").alias("consumer"),
        F.col("o_orderpriority").alias("prerequisite_job_nm"), F.lit("mart").alias("prerequisite_schema_nm"),
        F.lit("orders").alias("prerequisite_table_nm"), F.lit("daily").alias("frequency_check"),
        *[F.lit(None).cast("string").alias(c) for c in ("value", "data_column", "back_day")],
        F.lit(0).alias("empty_flag"), F.lit("monthly").alias("frequency"), F.lit("yyyyMMdd").alias("label_pattern"),
        F.lit("%Y%m%d").alias("pattern"), F.lit("yyyyMMdd").alias("job_label_pattern"), F.col("ref_ts").alias("start_ts"),
    )
    name = f"tidemark_log_{uuid.uuid4().hex[:10]}"
    loads.create_table(log, name, ["ictrl_dt"])
    try:
        found = rd.readiness(checks, name).select(
            "dep_id", _ref_date(), "ready", F.array_join("missing", ",").alias("missing"))
        return materialize(found, "verdicts")
    finally:
        loads.drop_table(spark, name)


def prereq_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = views.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat_ws(",", "o_orderpriority", F.lit("none"), F.lit(" "), F.lower("o_orderstatus"))
        .alias("prerequisite_job_nm"),
    )
    return rd.prerequisite_names(lists).select("o_orderkey", "name")


def workflow_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers as tables, suppliers as workflows, return flags as folders.

    The target days of a dependency are the ship days of its table.
    """
    items = views.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("folder_nm"),
        F.concat(F.lit("WF"), F.col("l_suppkey")).alias("workflow_nm"),
        F.concat(F.lit("t"), F.col("l_linenumber")).alias("tgt_obj"),
        F.when(F.col("l_discount") >= 0.09, "MANUAL").otherwise("AUTO").alias("workflow_type"),
        F.when(F.col("l_tax") >= 0.08, 1).otherwise(0).alias("obs_ind"),
        F.when(F.col("l_linestatus") == "F", "Succeeded").otherwise("Failed").alias("stat"),
        F.col("l_shipdate").alias("xtr_end_dt"),
    )
    completions = workflow.last_completions(
        items, items,
        control.frame(spark, control.FOLDER_SCHEMAS, control.FOLDER_COLUMNS),
        control.frame(spark, [("MANUAL",)], {"workflow_type": "string"}),
        control.frame(spark, [("WF1",), ("WF7",)], {"workflow_nm": "string"}),
    )
    deps = control.frame(spark, control.WORKFLOW_DEPS, control.WORKFLOW_DEP_COLUMNS).withColumn(
        "names", F.split("names", ",")
    )
    days = items.select(
        F.upper("tgt_obj").alias("table_key"), F.to_date("xtr_end_dt").alias("target_day")
    ).distinct()
    targets = deps.select("dep_id", F.upper("table_nm").alias("table_key")).join(days, "table_key")
    verdict = workflow.workflow_complete(deps, targets, completions)
    return verdict.withColumn("target_day", F.date_format("target_day", "yyyy-MM-dd"))


QUERIES = {
    **{name: _ready(which) for name, which in SELECTIONS.items()},
    "dependency_fanout": dependency_fanout,
    "log_lookup": log_lookup,
    "log_partitioned": log_partitioned,
    "two_log_fallback": two_log_fallback,
    "workflow_complete": workflow_complete,
    "job_ready_rollup": job_ready_rollup,
    "prereq_names": prereq_names,
}


# --- the same in SQL -----------------------------------------------------------------

_R, _V = "ref_ts", "COALESCE(TRY_CAST(value AS INTEGER), 0)"
_TOD = "(ref_ts - date_trunc('day', ref_ts))"


def _date(year: str, month: str, day: str) -> str:
    return (
        f"(try_strptime(({year}) || '-' || ({month}) || '-' || ({day}), '%Y-%m-%d') + {_TOD})"
    )


def _daily(low: str, high: str) -> str:
    return f"generate_series({low}, {high}, INTERVAL 1 DAY)"


def _hourly(low: str, high: str) -> str:
    return f"generate_series({low}, {high}, INTERVAL 1 HOUR)"


_QSTART = _date(f"year({_R}) - CASE WHEN {_V} > quarter({_R}) THEN 1 ELSE 0 END", f"{_V} * 3 - 2", "1")
_MTD_END = (
    f"{_date(f'year({_R})', f'month({_R})', _V)} - "
    "CASE WHEN frequency = 'monthly' AND COALESCE(TRY_CAST(back_day AS INTEGER), 0) = 0 "
    "THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END"
)
_MONTH_START = _date(f"year({_R})", f"month({_R})", "1")
_PREV = f"({_R} - INTERVAL 1 MONTH)"
_DAY0 = f"date_trunc('day', {_R})"
_START0 = "date_trunc('day', start_ts)"
# Dates of each check as a SQL list; NULL marks an impossible value.
EXPECTED = {
    "daily": f"[{_R}]",
    "weekly": f"[{_R} - to_days(((dayofweek({_R}) + 7 - {_V}) % 7)::INTEGER)]",
    "cur_month": f"[{_date(f'year({_R})', f'month({_R})', _V)}]",
    "prev_month": f"[{_date(f'year({_PREV})', f'month({_PREV})', _V)}]",
    "eom": f"[last_day({_PREV}) + {_TOD}]",
    "day-n": f"[{_R} - to_days({_V})]",
    "hourly": f"[{_R} - to_hours({_V})]",
    "quarter": f"CASE WHEN {_V} BETWEEN 1 AND 4 THEN " + _daily(
        _QSTART, f"CASE WHEN {_V} = quarter({_R}) THEN {_R} "
                 f"ELSE {_QSTART} + INTERVAL 3 MONTH - INTERVAL 1 DAY END") + " END",
    "month_to_date": _daily(_MONTH_START, _MTD_END),
    "year_to_date": _daily(_date(f"year({_R})", "1", "1"),
                           f"{_date(f'year({_R})', '1', '1')} + to_days({_V} - 1)"),
    "hour_to_date": _hourly(_DAY0, f"{_DAY0} + to_hours({_V})"),
    "daily_period": (
        f"CASE WHEN frequency = 'daily' THEN {_daily(_START0, _DAY0)} ELSE "
        f"list_filter(list_transform(range(0, 12), lambda k: date_trunc('month', {_START0}) "
        "+ to_months(k::INTEGER) + to_days((list_min([day(start_ts)] || list_transform("
        f"range(0, k + 1), lambda i: day(last_day(date_trunc('month', {_START0}) "
        "+ to_months(i::INTEGER))))) - 1)::INTEGER)), "
        f"lambda d: d <= {_DAY0}) END"
    ),
    "date_range": _daily(f"{_R} - to_days({_V})", _R),
    "date_in_range": (
        f"list_transform(range(-{_V}, {_V} + 1), lambda k: CASE WHEN frequency = 'weekly' THEN "
        f"{_R} + to_days((7 * k)::INTEGER) ELSE {_R} + to_months(k::INTEGER) END)"
    ),
    "max_date": f"[{_R}]",
    "24hours": _hourly(_DAY0, f"{_DAY0} + INTERVAL 23 HOUR"),
    "every_n_hour": _hourly(_DAY0, f"{_DAY0} + INTERVAL 23 HOUR"),
}


def verdict_ctes(which: str = "true") -> str:
    """CTEs ending in ``verdicts``: dep_id, job_nm, prerequisite, ref_ts, ready, missing, reason."""
    branches = " ".join(f"WHEN '{k}' THEN {dates}" for k, dates in EXPECTED.items())
    return f"""WITH checks AS (
      SELECT d.*, j.frequency, j.back_day, r.ref_ts,
             j.job_type NOT IN ('transform', 'outbound') AS ingest,
             r.ref_ts - to_days(CASE WHEN j.frequency = 'monthly' THEN 70 ELSE 3 END) AS start_ts
      FROM deps d JOIN jobs j USING (job_nm) JOIN refs r USING (clock)
      WHERE upper(d.active_flag) = 'Y' AND {which}
    ), dated AS (
      SELECT *, CASE
          WHEN ingest AND frequency_check NOT IN ('daily', 'hourly', '24hours', 'every_n_hour')
            OR NOT ingest AND frequency_check IN ('24hours', 'every_n_hour', 'hour_in_range')
          THEN 'unsupported' END AS refused,
        CASE WHEN frequency_check = 'every_n_hour'
             THEN trunc(24 / nullif(CAST(value AS INTEGER), 0)) END AS required,
        CASE frequency_check {branches} END AS dates
      FROM checks
    ), judged AS (
      SELECT *, COALESCE(refused, CASE
          WHEN dates IS NULL OR list_contains(list_transform(dates, lambda d: d IS NULL), true)
            OR frequency_check = 'every_n_hour' AND required IS NULL THEN 'invalid_value'
          WHEN len(dates) = 0 THEN 'empty_window' END) AS problem
      FROM dated
    ), wanted AS (
      SELECT DISTINCT dep_id, ref_ts, {fmt('d', 'ictrl_dt_tgtfmt')} AS label
      FROM (SELECT dep_id, ref_ts, ictrl_dt_tgtfmt, unnest(dates) AS d
            FROM judged WHERE problem IS NULL AND frequency_check <> 'max_date')
    ), runs AS (
      SELECT log_kind, upper(job_nm) AS job_key, schema_nm, table_nm, ictrl_dt AS label,
             job_start_time, round_time, dag_run_id, status IN ('SUCCEED', 'SUCCESS') AS good,
             COALESCE(row_cnt, 0) AS row_cnt
      FROM audit_log
    ), newest_run AS (
      SELECT * FROM (SELECT *, row_number() OVER (
          PARTITION BY log_kind, job_key, schema_nm, table_nm, label
          ORDER BY job_start_time DESC, round_time DESC, dag_run_id DESC) AS rn FROM runs)
      WHERE rn = 1
    ), logged AS (
      SELECT r.log_kind, r.job_key, r.schema_nm, r.table_nm, r.label,
             max(CASE WHEN r.good THEN r.row_cnt END) AS best_rows,
             any_value(CASE WHEN n.good THEN n.row_cnt END) AS latest_rows,
             max(r.job_start_time) AS started, max(CASE WHEN r.good THEN r.job_start_time END) AS good_started
      FROM runs r JOIN newest_run n USING (log_kind, job_key, schema_nm, table_nm, label)
      GROUP BY ALL
    ), routed AS (
      SELECT *, UNNEST(CASE WHEN data_column IS NOT NULL THEN ['raw']
                            WHEN ingest THEN ['ingest'] ELSE ['trans', 'ingest'] END) AS route
      FROM judged
    ), found AS (
      SELECT c.dep_id, c.ref_ts, c.route, w.label,
        CASE c.route WHEN 'raw' THEN EXISTS (
            SELECT 1 FROM raw_observed o WHERE o.table_nm = c.prerequisite_table_nm
              AND o.data_column = c.data_column AND o.label = w.label)
        ELSE
          CASE WHEN c.frequency_check IN ('daily','weekly','cur_month','prev_month','eom','day-n','hourly')
          THEN COALESCE(l.latest_rows, -1) >= c.empty_flag
          WHEN c.required <= 0 THEN l.label IS NOT NULL
          ELSE COALESCE(l.best_rows, -1) >= c.empty_flag END
        END AS present
      FROM routed c JOIN wanted w USING (dep_id, ref_ts)
      LEFT JOIN logged l ON l.log_kind = c.route AND l.job_key = upper(c.prerequisite_job_nm)
        AND l.schema_nm = c.prerequisite_schema_nm AND l.table_nm = c.prerequisite_table_nm
        AND l.label = w.label
      WHERE c.problem IS NULL AND NOT (c.ingest AND c.route = 'ingest'
                                       AND c.frequency_check IN ('daily', 'hourly'))
      UNION ALL
      SELECT c.dep_id, c.ref_ts, c.route, w.label,
        COALESCE((SELECT arg_max(CASE WHEN r.good THEN r.row_cnt ELSE -1 END,
                                 (r.job_start_time, r.round_time, r.dag_run_id))
         FROM runs r
         WHERE r.log_kind = 'ingest' AND r.job_key = upper(c.prerequisite_job_nm)
           AND r.schema_nm = c.prerequisite_schema_nm
           AND r.table_nm = split_part(c.prerequisite_table_nm, ' ', 1)
           AND starts_with(r.label, w.label)), -1) >= c.empty_flag
      FROM routed c JOIN wanted w USING (dep_id, ref_ts)
      WHERE c.problem IS NULL AND c.ingest AND c.route = 'ingest'
        AND c.frequency_check IN ('daily', 'hourly')
    ), newest_date AS (
      SELECT d.dep_id, r.log_kind AS route, max(try_strptime(r.label, '%Y%m%d')) AS newest_ts
      FROM deps d JOIN runs r ON r.job_key = upper(d.prerequisite_job_nm)
        AND r.schema_nm = d.prerequisite_schema_nm AND r.table_nm = d.prerequisite_table_nm
      WHERE d.frequency_check = 'max_date' AND d.data_column IS NULL
        AND r.good AND r.row_cnt >= d.empty_flag GROUP BY ALL
      UNION ALL
      SELECT d.dep_id, 'raw', max(try_strptime(o.label, '%Y%m%d')) FROM deps d
      JOIN raw_observed o ON o.table_nm = d.prerequisite_table_nm AND o.data_column = d.data_column
      WHERE d.frequency_check = 'max_date' GROUP BY ALL
    ), per_route AS (
      SELECT c.dep_id, c.job_nm, c.prerequisite_job_nm, c.ref_ts, c.route, c.problem,
        CASE WHEN c.frequency_check = 'max_date'
          THEN CASE WHEN any_value(n.newest_ts) >= c.ref_ts THEN []
                    ELSE [{fmt('c.ref_ts', 'any_value(c.ictrl_dt_tgtfmt)')}] END
          ELSE COALESCE(list_sort(list(f.label) FILTER (WHERE NOT f.present)), []) END AS missing,
        any_value(CASE WHEN c.frequency_check = 'every_n_hour'
                  THEN 24 - greatest(c.required, 1) ELSE 0 END) AS allowed
      FROM routed c LEFT JOIN found f USING (dep_id, ref_ts, route)
      LEFT JOIN newest_date n USING (dep_id, route)
      GROUP BY c.dep_id, c.job_nm, c.prerequisite_job_nm, c.ref_ts, c.route, c.problem, c.frequency_check
    ), decided AS (
      SELECT *, problem IS NULL AND len(missing) <= allowed AS ok FROM per_route
    ), verdicts AS (
      SELECT dep_id, job_nm, prerequisite_job_nm, ref_ts, bool_or(ok) AS ready,
        CASE WHEN bool_or(ok) OR max(problem) IS NOT NULL THEN []
             ELSE any_value(missing) FILTER (WHERE route <> 'trans') END AS missing,
        CASE WHEN NOT bool_or(ok) THEN COALESCE(max(problem), 'missing') END AS reason
      FROM decided GROUP BY ALL
    )
    """


VERDICT_VIEWS = "order_log audit_log raw_observed jobs deps refs"
_SHOWN = """SELECT dep_id, strftime(ref_ts, '%Y-%m-%d %H') AS ref_date, ready,
  CAST(len(missing) AS BIGINT) AS missing_cnt, array_to_string(missing, ',') AS missing, reason
  FROM verdicts"""

ORACLES = {
    **{name: with_views(VERDICT_VIEWS, verdict_ctes(which) + _SHOWN)
       for name, which in SELECTIONS.items()},
    "dependency_fanout": with_views("jobs deps refs job_starts", """
      SELECT s.job_nm, strftime(s.start_time, '%Y-%m-%d %H') AS start_time, d.dep_id,
        d.prerequisite_job_nm, d.frequency_check
      FROM job_starts s JOIN deps d ON d.job_nm = s.job_nm WHERE upper(d.active_flag) = 'Y'"""),
    "log_lookup": with_views(VERDICT_VIEWS, verdict_ctes(
        _LOG + _of("date_range", "weekly", "24hours")) + """
      SELECT c.dep_id, strftime(c.ref_ts, '%Y-%m-%d %H') AS ref_date, c.route, w.label,
        COALESCE(l.best_rows, -1) AS best_rows, COALESCE(l.latest_rows, -1) AS latest_rows
      FROM routed c JOIN wanted w USING (dep_id, ref_ts)
      LEFT JOIN logged l ON l.log_kind = c.route AND l.job_key = upper(c.prerequisite_job_nm)
        AND l.schema_nm = c.prerequisite_schema_nm AND l.table_nm = c.prerequisite_table_nm
        AND l.label = w.label
      WHERE c.problem IS NULL"""),
    "log_partitioned": with_views("order_log", """WITH newest AS (
        SELECT log_kind, job_nm, date_trunc('month', job_start_time) AS d,
          arg_max(status, (job_start_time, round_time, dag_run_id)) AS status
        FROM order_log GROUP BY ALL),
      asked AS (SELECT DISTINCT o_orderpriority AS dep_id, date_trunc('month', o_orderdate) AS d FROM orders),
      told AS (SELECT a.*, EXISTS (SELECT 1 FROM newest n WHERE n.job_nm = a.dep_id AND n.d = a.d AND n.status = 'SUCCEED') AS ready FROM asked a)
      SELECT dep_id, strftime(d, '%Y-%m-%d %H') AS ref_date, ready, CASE WHEN ready THEN '' ELSE strftime(d, '%Y%m%d') END AS missing FROM told"""),
    "two_log_fallback": with_views(VERDICT_VIEWS, verdict_ctes(
        _TWO_LOGS.replace("job_nm", "d.job_nm")) + """
      SELECT dep_id, strftime(ref_ts, '%Y-%m-%d %H') AS ref_date,
        bool_or(ok AND route = 'trans') AS in_trans, bool_or(ok AND route = 'ingest') AS in_ingest,
        bool_or(ok) AS ready FROM decided GROUP BY dep_id, ref_ts"""),
    "workflow_complete": f"""WITH deps AS (
        {control.values_sql(control.WORKFLOW_DEPS, control.WORKFLOW_DEP_COLUMNS)}
      ), folders AS ({control.values_sql(control.FOLDER_SCHEMAS, control.FOLDER_COLUMNS)}
      ), items AS (SELECT l_returnflag AS folder, 'WF' || l_suppkey AS wf, l_linenumber, l_discount,
          l_tax, l_linestatus, CAST(l_shipdate AS DATE) AS day FROM lineitem
      ), done AS (SELECT folder, wf, max(day) AS last_day FROM items WHERE l_linestatus = 'F' GROUP BY ALL
      ), writers AS (SELECT DISTINCT f.schema_nm, 't' || l_linenumber AS tbl, wf, folder
          FROM items JOIN folders f ON f.folder_nm = folder
          WHERE l_tax < 0.08 AND l_discount < 0.09 AND wf NOT IN ('WF1', 'WF7')
      ), days AS (SELECT DISTINCT 't' || l_linenumber AS tbl, day FROM items)
      SELECT d.dep_id, strftime(y.day, '%Y-%m-%d') AS target_day, COALESCE(bool_and(
          w.wf IS NOT NULL AND COALESCE(e.last_day >= y.day, false)), false) AS ready
      FROM deps d JOIN days y ON y.tbl = lower(d.table_nm)
      LEFT JOIN writers w ON upper(w.schema_nm) = upper(d.schema_nm) AND upper(w.tbl) = upper(d.table_nm)
        AND (d.names IS NULL OR list_contains(string_split(d.names, ','), w.wf))
      LEFT JOIN done e ON e.folder = w.folder AND e.wf = w.wf
      GROUP BY d.dep_id, y.day""",
    "job_ready_rollup": with_views(VERDICT_VIEWS, verdict_ctes() + """
      SELECT j.job_nm, strftime(r.ref_ts, '%Y-%m-%d %H') AS ref_date,
        COALESCE(bool_and(v.ready), true) AS ready,
        COALESCE(array_to_string(list_sort(list(DISTINCT v.prerequisite_job_nm)
          FILTER (WHERE NOT v.ready)), ','), '') AS not_ready
      FROM jobs j JOIN refs r USING (clock) LEFT JOIN verdicts v
        ON v.job_nm = j.job_nm AND v.ref_ts = r.ref_ts
      GROUP BY j.job_nm, r.ref_ts"""),
    "prereq_names": """SELECT o_orderkey, o_orderpriority AS name FROM orders
      UNION ALL SELECT o_orderkey, o_orderstatus FROM orders""",
}
