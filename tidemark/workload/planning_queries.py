"""Job selection, control-date arithmetic, catch-up and business-date scans."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import frequency as freq
from tidemark.functions import labels
from tidemark.operators import loads, planning, raw_dates
from tidemark.session import materialize
from tidemark.sources.key_value import wide_rows
from tidemark.workload import control, views
from tidemark.workload.oracle_views import fmt, parsed, with_views

_SHOW = "yyyy-MM-dd HH:mm"
_SHOW_SQL = "%Y-%m-%d %H:%M"
_GROUPS = [("Building",), ("MACHINERY",)]


# --- selection ----------------------------------------------------------------------


def _customer_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return views.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("job_nm"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lower(segment)).otherwise(segment)
        .alias("tasksgroup_nm"),
        F.expr("array('Y', 'y', 'N', 'n')[c_nationkey % 4]").alias("active_flag"),
    )


def active_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs of two requested groups, and jobs requested by name by an urgent order."""
    jobs = _customer_jobs(spark, sf_dir)
    groups = control.frame(spark, _GROUPS, {"tasksgroup_nm": "string"})
    urgent = views.table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    names = jobs.join(
        urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi"
    ).select(F.upper("job_nm").alias("job_nm"))
    by_group = planning.active_jobs(jobs, groups).withColumn("requested_by", F.lit("group"))
    by_name = planning.active_jobs(jobs, names, by="job_nm").withColumn(
        "requested_by", F.lit("name")
    )
    return by_group.unionByName(by_name).select("requested_by", "job_nm", "tasksgroup_nm")


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def resolve_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers looked up in six tables of completed or open orders."""
    orders = views.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey")).alias("name"), "o_orderstatus", "o_orderpriority"
    )
    done = orders.filter("o_orderstatus = 'F'")
    tables = {
        kind: done.filter(F.col("o_orderpriority") == priority)
        for kind, priority in zip(schemas.JOB_TYPE_PRIORITY, _PRIORITIES, strict=False)
    }
    tables["kafka"] = orders.filter("o_orderstatus = 'O'")
    customers = views.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("name"))
    suppliers = views.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("name"))
    return planning.resolve_by_priority(customers.unionByName(suppliers), tables, "name")


# --- date arithmetic over one row per order ----------------------------------------------


def _dated(expression: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return views.freq_rows(spark, sf_dir).select(
            "o_orderkey", F.date_format(F.expr(expression), _SHOW).alias("control_date")
        )

    return query


def render_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.freq_rows(spark, sf_dir).select(
        "o_orderkey", F.expr(labels.render("ts", "pattern")).alias("label")
    )


def parse_control_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each label read with its own pattern and, mostly in vain, with the default one."""
    rows = views.freq_rows(spark, sf_dir).select(
        "o_orderkey", "pattern", F.expr(labels.render("ts", "pattern")).alias("label")
    )
    default = f"'{labels.DEFAULT_PATTERN}'"
    return rows.select(
        "o_orderkey",
        F.date_format(F.expr(labels.parse("label", "pattern")), _SHOW).alias("own"),
        F.date_format(F.expr(labels.parse("label", default)), _SHOW).alias("by_default"),
    )


def range_or_set_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each priority asks for the days of its pending orders, in three label patterns."""
    rows = views.freq_rows(spark, sf_dir).select(
        "o_orderkey", "pattern", F.expr(labels.render("ts", "pattern")).alias("label")
    )
    pending = views.table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    wanted = rows.join(pending, "o_orderkey").select(
        F.col("o_orderpriority").alias("dep_id"), "pattern", "label"
    )
    return raw_dates.range_or_set_scan(rows, "label", wanted)


# --- planning over jobs x start times --------------------------------------------------


def _shown_start(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        "job_nm", F.date_format("start_time", _SHOW).alias("start_time"),
        *[F.date_format(c, _SHOW).alias(c) for c in columns],
    )


def master_ref_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_start(planning.with_master_ref_date(views.job_starts(spark, sf_dir)), "ref_ts")


def start_control_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = planning.plan_dates(views.job_starts(spark, sf_dir))
    return _shown_start(dated, "start_ts", "loop_ts")


def catchup_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = planning.plan_dates(views.job_starts(spark, sf_dir))
    return _shown_start(planning.catchup_expand(dated), "run_ts")


def run_range_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = planning.planned_runs(views.job_starts(spark, sf_dir))
    return runs.select(
        "job_nm", F.date_format("start_time", _SHOW).alias("start_time"),
        "ictrl_dt", "start_ictrl_dt", "end_ictrl_dt", "start_with_overlap",
    )


# --- delays --------------------------------------------------------------------------


def _delays(spark: SparkSession) -> DataFrame:
    return control.frame(spark, control.DELAYS, control.DELAY_COLUMNS)


def _delay_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("job_nm"), F.to_date("ts").alias("ref_date")
    ).distinct()


def _delay(mode: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        delays = _delays(spark).filter((F.lower("mode") == mode) | (F.lower("mode") == "yearly"))
        schedule = planning.delay_schedule(_delay_requests(spark, sf_dir), delays)
        return schedule.select(
            "job_nm", F.date_format("ref_date", "yyyy-MM-dd").alias("ref_date"),
            F.array_join("delay_days", ",").alias("delay_days"), "last_day",
        )

    return query


def delay_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    schedule = planning.delay_schedule(_delay_requests(spark, sf_dir), _delays(spark))
    status = planning.delay_status(schedule, views.audit_log(spark, sf_dir))
    return status.select(
        "job_nm", F.date_format("ref_date", "yyyy-MM-dd").alias("ref_date"), "delay_status"
    )


# --- scans ----------------------------------------------------------------------------


def kv_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = views.table(spark, sf_dir, "labels")
    pairs = marks.select(
        "doc_id", F.explode(F.create_map(
            F.lit("quality"), F.col("quality").cast("string"),
            F.lit("toxic"), F.col("toxic").cast("string"),
        )).alias("key", "value"),
    )
    return wide_rows(pairs, {"quality": "int", "toxic": "int", "language": "string"}, "doc_id")


_YEAR = ("19970101", "19971231")


def raw_dates_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_dates.dates_equal(views.raw_daily(spark, sf_dir), "business_date", "19980115")


def raw_dates_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year of dates, and the set of dates with a failed run."""
    raw = views.raw_daily(spark, sf_dir)
    failed = views.order_log(spark, sf_dir).filter("status = 'FAILED'")
    in_set = raw_dates.dates_in(
        raw, "business_date", failed.select(F.col("ictrl_dt").alias("label"))
    )
    return raw_dates.dates_between(raw, "business_date", *_YEAR).select(
        F.lit("range").alias("kind"), "business_date"
    ).unionByName(in_set.select(F.lit("set").alias("kind"), "business_date"))


def raw_dates_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_dates.dates_all(views.raw_hourly(spark, sf_dir), "business_hour")


def raw_dates_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_dates.dates_from(views.raw_daily(spark, sf_dir), "business_date", "20010101")


def _with_table(spark: SparkSession, df: DataFrame, partition_by: list[str], query) -> DataFrame:
    """What ``query`` finds in a table of the catalog made of ``df``, written before the table goes."""
    name = f"tidemark_dates_{uuid.uuid4().hex[:10]}"
    loads.create_table(df, name, partition_by)
    try:
        return materialize(query(name), "dates")
    finally:
        loads.drop_table(spark, name)


def raw_dates_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four scans of a table partitioned by its business month, from the list of its partitions."""
    months = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(F.date_trunc("month", "o_orderdate"), "yyyyMMdd").alias("business_date"))

    def scans(name: str) -> DataFrame:
        dates = raw_dates.business_dates(spark, name, "business_date")
        found = {
            "eq": raw_dates.dates_equal(dates, "business_date", "19980101"),
            "range": raw_dates.dates_between(dates, "business_date", "19980101", "19981231"),
            "all": raw_dates.dates_all(dates, "business_date"), "from": raw_dates.dates_from(dates, "business_date", "20010101"),
        }
        return reduce(DataFrame.unionByName, [d.select(F.lit(k).alias("kind"), "business_date") for k, d in found.items()])

    return _with_table(spark, months, ["business_date"], scans)


def raw_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest order day as a date and as a number, from the statistics of the files."""
    days = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("number"))

    def newest(name: str) -> DataFrame:
        rows = [(c, raw_dates.newest_label(spark, name, c, [p])) for c, p in (("day", "yyyy-MM-dd"), ("number", "yyyyMMdd"))]
        return spark.createDataFrame(rows, "column_nm string, label string")

    return _with_table(spark, days, [], newest)


QUERIES = {
    "active_jobs": active_jobs,
    "resolve_by_priority": resolve_by_priority,
    "date_minus_freq": _dated(freq.minus_steps("ts", "frequency", "n")),
    "date_add_freq": _dated(freq.plus_steps("ts", "frequency", "n")),
    "overlap_start": _dated(freq.overlap_start("ts", "frequency", "nullif(n, '0')")),
    "render_label": render_label,
    "parse_control_date": parse_control_date,
    "range_or_set_scan": range_or_set_scan,
    "master_ref_date": master_ref_date,
    "start_control_date": start_control_date,
    "catchup_expand": catchup_expand,
    "run_range_labels": run_range_labels,
    "delay_week": _delay("week"),
    "delay_month": _delay("month"),
    "delay_status": delay_status,
    "kv_pivot": kv_pivot,
    "raw_dates_eq": raw_dates_eq,
    "raw_dates_range": raw_dates_range,
    "raw_dates_all": raw_dates_all,
    "raw_dates_from": raw_dates_from,
    "raw_dates_listed": raw_dates_listed,
    "raw_newest": raw_newest,
}


# --- the same in SQL -----------------------------------------------------------------


def stepped(ts: str, frequency: str, n: str) -> str:
    """A date moved by n steps, one CASE arm per frequency that occurs."""
    return f"""CASE coalesce(nullif({frequency}, ''), 'daily')
      WHEN '15m' THEN {ts} + to_minutes(15 * ({n})) WHEN '30m' THEN {ts} + to_minutes(30 * ({n}))
      WHEN 'hourly' THEN {ts} + to_hours({n}) WHEN '2h' THEN {ts} + to_hours(2 * ({n}))
      WHEN '6h' THEN {ts} + to_hours(6 * ({n}))
      WHEN 'daily' THEN {ts} + to_days(CAST({n} AS INTEGER))
      WHEN 'weekly' THEN {ts} + to_days(CAST(7 * ({n}) AS INTEGER))
      WHEN 'monthly' THEN {ts} + to_months(CAST({n} AS INTEGER))
      WHEN 'quarterly' THEN {ts} + to_months(CAST(3 * ({n}) AS INTEGER))
      WHEN 'yearly' THEN {ts} + to_years(CAST({n} AS INTEGER)) END"""


def _shown(ts: str, name: str) -> str:
    return f"strftime({ts}, '{_SHOW_SQL}') AS {name}"


_INGEST = "job_type NOT IN ('transform', 'outbound')"
_SEQUENCE = f"({_INGEST} OR catchup_type = 'sequence')"
_BACK = "-coalesce(CAST(back_day AS INTEGER), 0)"
_OVERLAP = "-coalesce(CAST(overlap AS INTEGER), 0)"
PLANNED = f"""WITH referred AS (
      SELECT *, CASE WHEN fixed_date IS NOT NULL THEN {parsed('fixed_date', 'ictrl_dt_tgtfmt')}
        ELSE {stepped('start_time', 'frequency', _BACK)} END AS ref_ts,
        {parsed('last_success_ictrl_dt', 'ictrl_dt_tgtfmt')} AS mark
      FROM job_starts
    ), started AS (
      SELECT *, CASE WHEN cdr_flag = 'Y' AND job_type = 'file' OR mark IS NULL THEN ref_ts
        WHEN {_SEQUENCE} THEN {stepped('mark', 'frequency', '1')} ELSE mark END AS start_ts
      FROM referred
    ), planned AS (
      SELECT *, CASE WHEN {_INGEST} THEN start_ts
        ELSE {stepped('start_ts', 'frequency', _OVERLAP)} END AS loop_ts
      FROM started
    ), runs AS (
      SELECT *, loop_ts AS run_ts FROM planned WHERE {_SEQUENCE} AND loop_ts <= ref_ts
      UNION ALL
      SELECT * EXCLUDE (next_ts) REPLACE (next_ts AS run_ts)
      FROM (SELECT *, {stepped('run_ts', 'frequency', '1')} AS next_ts FROM runs)
      WHERE next_ts <= ref_ts
    ), all_runs AS (
      SELECT * FROM runs UNION ALL SELECT *, ref_ts FROM planned WHERE NOT {_SEQUENCE}
    ) """
PLAN_VIEWS = "jobs refs job_starts"
_START = _shown("start_time", "start_time")
_RUN_OVERLAP = f"""CASE WHEN {_INGEST} THEN {stepped('run_ts', 'frequency',
    "CASE WHEN job_type = 'kafka' THEN 0 ELSE " + _OVERLAP + " END")} ELSE loop_ts END"""


def _delay_sql(modes: str, final: str) -> str:
    return with_views("order_log audit_log", f"""WITH delays AS (
      {control.values_sql(control.DELAYS, control.DELAY_COLUMNS)}
    ), requests AS (
      SELECT DISTINCT event_type AS job_nm, CAST(ts AS DATE) AS ref_date FROM events
    ), based AS (
      SELECT r.job_nm, r.ref_date, TRY_CAST(d.total_delay AS INTEGER) AS total,
        CASE lower(d.mode)
        WHEN 'week' THEN r.ref_date - CAST(dayofweek(r.ref_date) AS INTEGER) + CASE
          WHEN d.date_start_job ILIKE '%sunday%' THEN 0 WHEN d.date_start_job ILIKE '%monday%' THEN 1
          WHEN d.date_start_job ILIKE '%tuesday%' THEN 2 END
        WHEN 'month' THEN CASE WHEN CAST(d.date_start_job AS INTEGER) > day(r.ref_date)
          THEN CAST(date_trunc('month', r.ref_date) + to_days(CAST(d.date_start_job AS INTEGER) - 1)
               - INTERVAL 1 MONTH AS DATE)
          ELSE CAST(date_trunc('month', r.ref_date) + to_days(CAST(d.date_start_job AS INTEGER) - 1) AS DATE) END
        END AS base
      FROM requests r LEFT JOIN (SELECT * FROM delays WHERE lower(job_type) = 'ingestion'
        AND lower(flag) <> 'n' AND lower(mode) IN ({modes})) d USING (job_nm)
    ), schedule AS (
      SELECT job_nm, ref_date, CASE WHEN base IS NULL THEN [] ELSE
        list_transform(range(0, total), lambda i: strftime(base + CAST(i AS INTEGER), '%Y-%m-%d')) END AS days
      FROM based
    ) {final}""")


_DELAY_SHOWN = """SELECT job_nm, strftime(ref_date, '%Y-%m-%d') AS ref_date,
  array_to_string(days, ',') AS delay_days, coalesce(days[-1], '-') AS last_day FROM schedule"""

ORACLES = {
    "active_jobs": f"""WITH jobs AS (
        SELECT c_custkey, c_name AS job_nm, CASE WHEN c_nationkey % 2 = 0 THEN lower(c_mktsegment)
          ELSE c_mktsegment END AS tasksgroup_nm, c_nationkey % 4 < 2 AS active FROM customer)
      SELECT 'group' AS requested_by, job_nm, tasksgroup_nm FROM jobs
      WHERE active AND lower(tasksgroup_nm) IN ('building', 'machinery')
      UNION ALL SELECT 'name', job_nm, tasksgroup_nm FROM jobs WHERE active AND c_custkey IN
        (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "resolve_by_priority": """WITH ranked AS (
        SELECT o_custkey, min(CASE WHEN o_orderstatus = 'F' THEN CAST(left(o_orderpriority, 1) AS INTEGER)
          WHEN o_orderstatus = 'O' THEN 6 END) AS best FROM orders GROUP BY o_custkey)
      SELECT 'C' || c_custkey AS name,
        ['transform','outbound','ingestApi','ingestDb','file','kafka'][best] AS job_type
      FROM customer LEFT JOIN ranked ON o_custkey = c_custkey
      UNION ALL SELECT 'S' || s_suppkey, NULL FROM supplier""",
    "date_minus_freq": with_views(
        "freq_rows", f"SELECT o_orderkey, {_shown(stepped('ts', 'frequency', '-n'), 'control_date')} FROM freq_rows"),
    "date_add_freq": with_views(
        "freq_rows", f"SELECT o_orderkey, {_shown(stepped('ts', 'frequency', 'n'), 'control_date')} FROM freq_rows"),
    "overlap_start": with_views(
        "freq_rows", f"SELECT o_orderkey, {_shown(stepped('ts', 'frequency', '-n'), 'control_date')} FROM freq_rows"),
    "render_label": with_views(
        "freq_rows", f"SELECT o_orderkey, {fmt('ts', 'pattern')} AS label FROM freq_rows"),
    "parse_control_date": with_views("freq_rows", f"""SELECT o_orderkey, {_shown('ts', 'own')},
      CASE WHEN pattern = '%Y%m%d' THEN strftime(ts, '{_SHOW_SQL}') END AS by_default FROM freq_rows"""),
    "range_or_set_scan": with_views("freq_rows", f"""WITH rows AS (
        SELECT o_orderkey, pattern, {fmt('ts', 'pattern')} AS label FROM freq_rows
      ), wanted AS (
        SELECT DISTINCT o_orderpriority AS dep_id, pattern, label FROM rows JOIN orders USING (o_orderkey)
        WHERE o_orderstatus = 'P'
      ), present AS (SELECT pattern, label, count(*) AS row_cnt FROM rows GROUP BY ALL
      ), spans AS (SELECT dep_id, pattern, min(label) AS low, max(label) AS high FROM wanted
        WHERE pattern <> '%d/%m/%Y' GROUP BY ALL)
      SELECT dep_id, pattern, label, row_cnt FROM present JOIN spans USING (pattern)
        WHERE label BETWEEN low AND high
      UNION ALL SELECT dep_id, pattern, label, row_cnt FROM present JOIN wanted USING (pattern, label)
        WHERE pattern = '%d/%m/%Y'"""),
    "master_ref_date": with_views(
        PLAN_VIEWS, PLANNED + f"SELECT job_nm, {_START}, {_shown('ref_ts', 'ref_ts')} FROM planned"),
    "start_control_date": with_views(PLAN_VIEWS, PLANNED + f"""SELECT job_nm, {_START},
        {_shown('start_ts', 'start_ts')}, {_shown('loop_ts', 'loop_ts')} FROM planned"""),
    "catchup_expand": with_views(
        PLAN_VIEWS, PLANNED + f"SELECT job_nm, {_START}, {_shown('run_ts', 'run_ts')} FROM all_runs"),
    "run_range_labels": with_views(PLAN_VIEWS, PLANNED + f"""SELECT job_nm, {_START},
        {fmt('run_ts', 'ictrl_dt_tgtfmt')} AS ictrl_dt, {fmt('loop_ts', 'ictrl_dt_tgtfmt')} AS start_ictrl_dt,
        {fmt('ref_ts', 'ictrl_dt_tgtfmt')} AS end_ictrl_dt,
        {fmt(_RUN_OVERLAP, 'ictrl_dt_tgtfmt')} AS start_with_overlap FROM all_runs"""),
    "delay_week": _delay_sql("'week', 'yearly'", _DELAY_SHOWN),
    "delay_month": _delay_sql("'month', 'yearly'", _DELAY_SHOWN),
    "delay_status": _delay_sql("'week', 'month', 'yearly'", """
      SELECT job_nm, strftime(ref_date, '%Y-%m-%d') AS ref_date, CASE
        WHEN len(days) = 0 THEN '-'
        WHEN NOT list_contains(days, strftime(ref_date, '%Y-%m-%d')) THEN 'Not a Date to do this job'
        WHEN EXISTS (SELECT 1 FROM audit_log a WHERE a.job_nm = s.job_nm
          AND a.status IN ('SUCCEED', 'SUCCESS')
          AND CAST(a.job_start_time AS DATE) BETWEEN s.ref_date - 1 AND s.ref_date)
        THEN 'Job Has already Done' ELSE '-' END AS delay_status
      FROM schedule s"""),
    "kv_pivot": "SELECT doc_id, quality, toxic, CAST(NULL AS VARCHAR) AS language FROM labels",
    "raw_dates_eq": """SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS business_date FROM orders
      WHERE o_orderdate = TIMESTAMP '1998-01-15'""",
    "raw_dates_range": """SELECT DISTINCT 'range' AS kind, strftime(o_orderdate, '%Y%m%d') AS business_date
      FROM orders WHERE year(o_orderdate) = 1997
      UNION ALL SELECT DISTINCT 'set', strftime(o_orderdate, '%Y%m%d') FROM orders WHERE o_orderstatus = 'P'""",
    "raw_dates_listed": """WITH d AS (SELECT DISTINCT strftime(date_trunc('month', o_orderdate), '%Y%m%d') AS business_date FROM orders)
        SELECT 'eq' AS kind, business_date FROM d WHERE business_date = '19980101'
        UNION ALL SELECT 'range', business_date FROM d WHERE business_date BETWEEN '19980101' AND '19981231'
        UNION ALL SELECT 'all', business_date FROM d
        UNION ALL SELECT 'from', business_date FROM d WHERE business_date >= '20010101'""",
    "raw_newest": """SELECT 'day' AS column_nm, strftime(max(o_orderdate), '%Y-%m-%d') AS label FROM orders
        UNION ALL SELECT 'number', strftime(max(o_orderdate), '%Y%m%d') FROM orders""",
    "raw_dates_all": "SELECT DISTINCT strftime(ts, '%Y%m%d%H') AS business_hour FROM events",
    "raw_dates_from": """SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS business_date FROM orders
      WHERE o_orderdate >= TIMESTAMP '2001-01-01'""",
}
