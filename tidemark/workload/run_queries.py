"""One composed run over the given tables: orders are staged, checked, loaded and recorded."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import loads
from tidemark.operators.validation import Rule
from tidemark.plans import run_plan
from tidemark.workload import views
from tidemark.workload.oracle_views import with_views

# A job stages the orders of its priority, or all of them. It is due from the first order's date to the last's.
# Its rows belong to the first day of their month or year where it does not run daily.
# job, type, call records, frequency, load mode, partition column, unique key; what it waits for: a job's runs in the
# log, the raw table of order dates, or nothing
RAW, NOTHING = "raw", None
JOBS = [
    ("1-URGENT", "transform", "N", "daily", "append", None, None, RAW),
    ("2-HIGH", "ingestDb", "N", "monthly", "overwrite", "ictrl_dt", None, RAW),
    ("3-MEDIUM", "file", "Y", "daily", "upsert", None, "['o_orderkey']", "4-NOT SPECIFIED"),
    ("4-NOT SPECIFIED", "transform", "N", "daily", "append", None, None, NOTHING),
    ("5-LOW", "file", "N", "daily", "full_load", None, None, "1-URGENT"),
    ("CUSTOMERS", "outbound", "N", "monthly", "upsert", None, "['o_custkey']", NOTHING),
    ("YEARS", "transform", "N", "yearly", "append", None, None, NOTHING),
]
# This job's table breaks its rule on its first date; the table of the other rule keeps it.
_BROKEN, _KEPT = "4-NOT SPECIFIED", "YEARS"


UNITS = {"daily": "day", "monthly": "month", "yearly": "year"}


def _staged(orders: DataFrame, job: str, often: str) -> DataFrame:
    """A job's rows with the label of the date each belongs to; customers come once a month."""
    label = F.date_format(F.date_trunc(UNITS[often], "o_orderdate"), "yyyyMMdd").alias("ictrl_dt")
    if job == "CUSTOMERS":
        return orders.groupBy("o_custkey", label).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("price"))
    own = orders if job == "YEARS" else orders.filter(F.col("o_orderpriority") == job)
    return own.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), label)


def composed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each job's watermark, started runs, loaded rows and their price, and what it ended at."""
    prefix = f"tidemark_run_{uuid.uuid4().hex[:10]}"
    tables = {job[0]: f"{prefix}_{i}" for i, job in enumerate(JOBS)}
    orders = views.table(spark, sf_dir, "orders")
    staged = {job[0]: _staged(orders, job[0], job[3]) for job in JOBS}
    for name, _, _, _, _, partition, _, _ in JOBS:
        loads.create_table(staged[name].limit(0), tables[name], run_plan.names(partition))
    span = orders.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("start_time"))
    jobs = spark.createDataFrame(
        [(job, "grp0", kind, "Y", often, "0", None, "sequence", "%Y%m%d", None, None, tables[job], mode,
          partition, key, None, None, cdr, "batch") for job, kind, cdr, often, mode, partition, key, _ in JOBS],
        schemas.JOBS,
    ).crossJoin(F.broadcast(span))  # one row
    earlier = " ".join(f"WHEN '{k}' THEN cast(date_trunc('{u}', first) AS timestamp_ntz) - INTERVAL 1 {u}" for k, u in UNITS.items())
    jobs = jobs.withColumn("last_success_ictrl_dt", F.expr(f"date_format(CASE frequency {earlier} END, 'yyyyMMdd')")).drop("first")
    dependencies = spark.createDataFrame(
        [(f"dep_{job}", job, "Y", "orders" if waits == RAW else waits, "mart", "raw_daily" if waits == RAW else "orders",
          "daily", None, 0, "business_date" if waits == RAW else None, "%Y%m%d")
         for job, *_, waits in JOBS if waits is not NOTHING],
        schemas.DEPENDENCIES,
    )
    log = views.order_log(spark, sf_dir).withColumn("err_msg", F.when(F.col("status") == "SUCCEED", "-"))
    rules = [Rule("price", tables[_BROKEN], "min(price)", ("price",), -1.0, "<="),
             Rule("keys", tables[_KEPT], "min(o_orderkey)", ("o_orderkey",), 0.0, ">=")]
    done = run_plan.execute(
        jobs, dependencies, log, None, staged, rules, "today", raw=views.raw_tables(spark, sf_dir))
    counts = spark.createDataFrame([
        (job, *spark.table(table).agg(F.count("*"), F.sum("price").cast("decimal(38,2)")).first()) for job, table in tables.items()
    ], "job_nm string, loaded_rows bigint, price decimal(38,2)")
    for table in tables.values():
        loads.drop_table(spark, table)
    started = done.events.filter("status = 'RUNNING'").groupBy("job_nm").agg(F.count("*").alias("started"))
    ends = done.state.filter("status = 'FAILED'").groupBy("job_nm").agg(
        F.max(F.when(F.col("err_msg").startswith("DropDuplicatesJobError"), "DropDuplicatesJobError").otherwise(F.col("err_msg")))
        .alias("ended"))
    return (
        done.jobs.select("job_nm", "last_success_ictrl_dt").join(counts, "job_nm").join(started, "job_nm", "left")
        .join(ends, "job_nm", "left")
        .select("job_nm", "last_success_ictrl_dt", "loaded_rows", F.coalesce("price", F.lit(0).cast("decimal(38,2)")).alias("price"),
                F.coalesce("started", F.lit(0)).alias("started"), "ended")
    )


QUERIES = {"composed_run": composed_run}

_JOBS_SQL = ", ".join(
    f"('{job}', {'true' if kind in schemas.INGEST_TYPES else 'false'}, {'true' if cdr == 'Y' else 'false'}, "
    f"'{UNITS[often]}', '{mode}', {'NULL' if waits is None else repr(waits)})"
    for job, kind, cdr, often, mode, _, _, waits in JOBS
)


ORACLES = {
    "composed_run": with_views("order_log", f"""WITH jobs(job_nm, ingests, call_records, unit, mode, waits) AS (VALUES {_JOBS_SQL}),
      span AS (SELECT min(o_orderdate) AS first, max(o_orderdate) AS now FROM orders),
      dates AS (
        SELECT 'day' AS unit, unnest(generate_series(first, now, INTERVAL 1 DAY)) AS d FROM span
        UNION ALL SELECT 'month', unnest(generate_series(date_trunc('month', first)::TIMESTAMP, now, INTERVAL 1 MONTH)) FROM span
        UNION ALL SELECT 'year', unnest(generate_series(date_trunc('year', first)::TIMESTAMP, now, INTERVAL 1 YEAR)) FROM span),
      runs AS (SELECT j.*, d, strftime(d, '%Y%m%d') AS label, now FROM jobs j JOIN dates USING (unit), span WHERE NOT call_records OR d = now),
      newest AS (SELECT log_kind, job_nm, ictrl_dt, arg_max(status, (job_start_time, round_time, dag_run_id)) AS status
        FROM order_log GROUP BY ALL),
      days AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS label FROM orders),
      judged AS (SELECT r.*,
        CASE WHEN waits IS NULL THEN true WHEN waits = '{RAW}' THEN strftime(d, '%Y%m%d') IN (SELECT label FROM days)
          ELSE EXISTS (SELECT 1 FROM newest n WHERE n.job_nm = r.waits AND n.ictrl_dt = r.label AND n.status = 'SUCCEED'
            AND (n.log_kind = 'ingest' OR NOT r.ingests)) END AS ready,
        EXISTS (SELECT 1 FROM order_log l WHERE l.job_nm = r.job_nm AND l.tasksgroup_nm = 'grp0'
          AND l.ictrl_dt = r.label AND l.status = 'SUCCEED') AS done,
        (NOT ingests AND EXISTS (SELECT 1 FROM order_log l WHERE l.job_nm = r.job_nm AND l.ictrl_dt = r.label
          AND l.status = 'RUNNING' AND l.round_time <> r.now AND l.job_start_time >= r.now - INTERVAL 3 HOUR))
        OR (ingests AND coalesce((SELECT CAST(max(l.round_time) AS DATE) = CAST(r.now AS DATE) FROM order_log l
          WHERE l.job_nm = r.job_nm AND l.tasksgroup_nm = 'grp0' AND l.status = 'RUNNING' AND l.round_time <> r.now
          AND (r.call_records OR l.ictrl_dt = r.label)), false)) AS blocked
        FROM runs r),
      stops AS (SELECT job_nm, min(d) AS stop, arg_min(CASE WHEN ready THEN 'DropDuplicatesJobError'
          ELSE 'The dependency job check failed because this job = ' || CASE waits WHEN '{RAW}' THEN 'orders' ELSE waits END
            || ' is not finished' END, d) AS ended
        FROM judged WHERE NOT done AND (NOT ready OR blocked) GROUP BY job_nm),
      due AS (SELECT j.* FROM judged j LEFT JOIN stops s USING (job_nm) WHERE s.stop IS NULL OR j.d < s.stop),
      -- the broken rule fails the job's first date that has to run
      failing AS (SELECT job_nm, min(d) AS failed_at FROM due WHERE job_nm = '{_BROKEN}' AND NOT done GROUP BY job_nm),
      reached AS (SELECT u.*, u.d = f.failed_at AS failed FROM due u LEFT JOIN failing f USING (job_nm)
        WHERE f.failed_at IS NULL OR u.d <= f.failed_at),
      started AS (SELECT * FROM reached WHERE NOT done),
      staged AS (
        SELECT j.job_nm, strftime(date_trunc(j.unit, o_orderdate), '%Y%m%d') AS label, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price
        FROM orders JOIN jobs j ON j.job_nm = o_orderpriority OR j.job_nm = 'YEARS'
        UNION ALL SELECT 'CUSTOMERS', strftime(date_trunc('month', o_orderdate), '%Y%m%d'), o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2))
        FROM orders GROUP BY ALL),
      kept AS (SELECT s.job_nm, s.d, g.o_custkey, g.price,
          CASE WHEN s.job_nm = 'CUSTOMERS' THEN max(s.d) OVER (PARTITION BY s.job_nm, g.o_custkey) END AS newest
        FROM started s JOIN staged g ON g.job_nm = s.job_nm AND g.label = s.label
        -- each date replaces a table loaded in full
        WHERE s.mode <> 'full_load' OR s.d = (SELECT max(d) FROM started x WHERE x.job_nm = s.job_nm)),
      loaded AS (SELECT job_nm, count(*) AS n, sum(price) AS price FROM kept WHERE newest IS NULL OR d = newest GROUP BY job_nm)
      SELECT j.job_nm, coalesce((SELECT arg_max(r.label, r.d) FROM reached r WHERE r.job_nm = j.job_nm AND NOT coalesce(r.failed, false)),
          (SELECT strftime(CASE j.unit WHEN 'day' THEN first - INTERVAL 1 DAY WHEN 'month' THEN date_trunc('month', first) - INTERVAL 1 MONTH
            ELSE date_trunc('year', first) - INTERVAL 1 YEAR END, '%Y%m%d') FROM span)
        ) AS last_success_ictrl_dt,
        coalesce(l.n, 0) AS loaded_rows, CAST(coalesce(l.price, 0) AS DECIMAL(38,2)) AS price,
        (SELECT count(*) FROM started s WHERE s.job_nm = j.job_nm) AS started,
        CASE WHEN f.job_nm IS NOT NULL THEN 'validation failed: price' ELSE s.ended END AS ended
      FROM jobs j LEFT JOIN loaded l USING (job_nm) LEFT JOIN stops s USING (job_nm) LEFT JOIN failing f USING (job_nm)"""),
}
