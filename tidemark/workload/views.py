"""Views over the given tables that stand in for logs, raw tables and configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import labels
from tidemark.operators.readiness import dependency_fanout
from tidemark.workload import control


# Declared, so that reading a table starts no job to infer its schema.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _seconds(n: Column) -> Column:
    days = F.floor(n / 86400).cast("int")
    return F.make_dt_interval(days, F.lit(0), F.lit(0), n - days * 86400)


def _day(ts: str) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def _hour(ts: str) -> Column:
    return F.date_format(ts, "yyyyMMddHH")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log of daily jobs: one run per order, under its priority."""
    start = F.col("o_orderdate") + _seconds(F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 2 == 1, "ingest").otherwise("trans").alias("log_kind"),
        F.col("o_orderpriority").alias("job_nm"),
        F.concat(F.lit("grp"), F.col("o_custkey") % 3).alias("tasksgroup_nm"),
        F.lit("mart").alias("schema_nm"), F.lit("orders").alias("table_nm"),
        F.col("o_orderkey").cast("string").alias("dag_run_id"),
        start.alias("round_time"), start.alias("job_start_time"),
        (start + _seconds(F.col("o_custkey") * 97)).alias("job_end_time"),
        _day("o_orderdate").alias("ictrl_dt"),
        F.when(F.col("o_orderstatus") == "F", "SUCCEED")
        .when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("FAILED").alias("status"),
        (F.col("o_custkey") % 5).alias("row_cnt"), "o_custkey",
    )


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order runs under their priority and under ALL, and hourly runs of the event types."""
    orders = order_log(spark, sf_dir).select(
        "log_kind", F.explode(F.array("job_nm", F.lit("ALL"))).alias("job_nm"),
        "schema_nm", "table_nm", "dag_run_id", "round_time", "job_start_time",
        "ictrl_dt", "status", "row_cnt",
    )
    events = table(spark, sf_dir, "events").select(
        F.lit("ingest").alias("log_kind"), F.col("event_type").alias("job_nm"),
        F.lit("mart").alias("schema_nm"), F.lit("events").alias("table_nm"),
        F.concat(F.lit("e"), F.col("event_id")).alias("dag_run_id"),
        F.col("ts").alias("round_time"), F.col("ts").alias("job_start_time"),
        _hour("ts").alias("ictrl_dt"),
        F.when(F.col("value") > 5, "SUCCESS").otherwise("FAILED").alias("status"),
        (F.col("user_id") % 5).alias("row_cnt"),
    )
    return orders.unionByName(events)


def raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderpriority", _day("o_orderdate").alias("business_date")
    )


def raw_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_type", _hour("ts").alias("business_hour")
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[tuple[str, str, str], DataFrame]:
    return {
        ("mart", "raw_daily", "business_date"): raw_daily(spark, sf_dir),
        ("mart", "raw_hourly", "business_hour"): raw_hourly(spark, sf_dir),
    }


def dependencies(spark: SparkSession) -> DataFrame:
    return control.frame(spark, control.DEPENDENCIES, control.DEPENDENCY_COLUMNS)


def jobs(spark: SparkSession) -> DataFrame:
    return control.frame(spark, control.JOBS, control.JOB_COLUMNS)


def reference_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill window: every order date, and every hour with an event."""
    days = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("clock"), F.col("o_orderdate").alias("ref_ts")
    )
    hours = table(spark, sf_dir, "events").select(
        F.lit("events").alias("clock"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ref_ts"),
    )
    return days.unionByName(hours).distinct()


def checks(
    spark: SparkSession, sf_dir: str, which: str = "true", dates: DataFrame | None = None
) -> DataFrame:
    """Every active dependency (that ``which`` selects) at every reference date."""
    wanted = dependencies(spark).filter(which)
    runs = jobs(spark).select(
        "job_nm", "clock", "frequency", "back_day",
        F.when(F.col("job_type").isin(*schemas.INGEST_TYPES), "ingest")
        .otherwise("transform").alias("consumer"),
        F.expr(labels.spark_pattern("ictrl_dt_tgtfmt")).alias("job_label_pattern"),
    ).join(reference_dates(spark, sf_dir) if dates is None else dates, "clock")
    back = F.when(F.col("frequency") == "monthly", 70).otherwise(3)
    return dependency_fanout(
        runs.withColumn("start_ts", F.col("ref_ts") - F.make_dt_interval(back)), wanted
    )


def freq_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One date, frequency, step count and pattern per order."""
    names = ["15m", "2h", "hourly", "daily", "weekly", "monthly", "quarterly", "yearly", ""]
    patterns = ["%Y%m%d", "%Y-%m-%d", "%d/%m/%Y"]

    def pick(values: list[str]) -> Column:
        position = (F.col("o_orderkey") % len(values)).cast("int")
        return F.get(F.array(*map(F.lit, values)), position)

    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("ts"), pick(names).alias("frequency"),
        (F.col("o_custkey") % 4).cast("string").alias("n"), pick(patterns).alias("pattern"),
    )


def job_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every job at every start time of the window, with a watermark some days older.

    Every fifth day of the month has no watermark yet, and every seventh a fixed date.
    """
    starts = reference_dates(spark, sf_dir).withColumnRenamed("ref_ts", "start_time")
    day = F.day("start_time")
    lag = "CASE WHEN frequency = 'monthly' THEN 95 WHEN clock = 'events' THEN 1 ELSE 9 END"
    watermark = labels.render(f"start_time - make_dt_interval({lag})", "ictrl_dt_tgtfmt")
    fixed = labels.render("start_time - INTERVAL '1' DAY", "ictrl_dt_tgtfmt")
    return jobs(spark).join(starts, "clock").withColumns({
        "last_success_ictrl_dt": F.when(day % 5 != 0, F.expr(watermark)),
        "fixed_date": F.when(day % 7 == 0, F.expr(fixed)),
    })
