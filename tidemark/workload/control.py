"""Small control tables used by the registered queries, stated once for both dialects.

Each is a list of rows; the Spark side turns it into a DataFrame and the SQL oracles
into a VALUES list. They only steer queries over the given data tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# job_nm, job_type, frequency, back_day, overlap, catchup_type, pattern, cdr_flag,
# clock (which data table supplies the job's reference dates)
JOBS = [
    ("load_daily", "transform", "daily", "1", "0", "sequence", "%Y%m%d", "N", "orders"),
    ("load_weekly", "transform", "weekly", "0", "1", "sequence", "%Y-%m-%d", "N", "orders"),
    ("load_monthly", "transform", "monthly", "0", None, "sequence", "%Y%m%d", "N", "orders"),
    ("send_daily", "outbound", None, "2", "2", "period", "%d/%m/%Y", "N", "orders"),
    ("pull_hourly", "ingestDb", "hourly", "1", "3", "period", "%Y%m%d%H", "N", "events"),
    ("load_hourly", "transform", "2h", None, "1", "sequence", "%Y%m%d%H", "N", "events"),
    ("read_files", "file", "6h", "1", "1", "sequence", "%Y-%m-%d %H", "Y", "events"),
    ("read_topic", "kafka", "30m", "2", "4", "sequence", "%Y%m%d%H%M", "N", "events"),
]
JOB_COLUMNS = {
    "job_nm": "string", "job_type": "string", "frequency": "string", "back_day": "string",
    "overlap": "string", "catchup_type": "string", "ictrl_dt_tgtfmt": "string",
    "cdr_flag": "string", "clock": "string",
}

_D, _H = "%Y%m%d", "%Y%m%d%H"
# dep_id, job_nm, active_flag, prerequisite job, schema, table, frequency_check, value,
# empty_flag, data_column, pattern
DEPENDENCIES = [
    ("daily_log", "load_daily", "Y", "1-urgent", "mart", "orders", "daily", None, 0, None, _D),
    ("daily_rows", "load_daily", "y", "ALL", "mart", "orders", "daily", None, 3, None, _D),
    ("daily_raw", "load_daily", "Y", "x", "mart", "raw_daily", "daily", None, 0, "business_date", _D),
    ("daily_prefix", "pull_hourly", "Y", "click", "mart", "events v", "daily", None, 1, None, _D),
    ("weekly_0", "load_weekly", "Y", "ALL", "mart", "orders", "weekly", "0", 0, None, _D),
    ("weekly_3", "load_weekly", "Y", "2-HIGH", "mart", "orders", "weekly", "3", 0, None, _D),
    ("cur_15", "load_monthly", "Y", "ALL", "mart", "orders", "cur_month", "15", 1, None, _D),
    ("cur_31", "load_monthly", "Y", "ALL", "mart", "orders", "cur_month", "31", 0, None, _D),
    ("prev_10", "load_monthly", "Y", "5-LOW", "mart", "orders", "prev_month", "10", 0, None, _D),
    ("prev_raw", "load_monthly", "Y", "x", "mart", "raw_daily", "prev_month", "30", 0, "business_date", _D),
    ("eom_log", "load_monthly", "Y", "ALL", "mart", "orders", "eom", None, 2, None, _D),
    ("day_n_2", "send_daily", "Y", "3-MEDIUM", "mart", "orders", "day-n", "2", 0, None, _D),
    ("hour_24", "load_daily", "Y", "ALL", "mart", "orders", "hourly", "24", 0, None, _D),
    ("hour_prefix", "pull_hourly", "Y", "view", "mart", "events", "hourly", "1", 0, None, _H),
    ("hour_raw", "load_hourly", "Y", "x", "mart", "raw_hourly", "hourly", "2", 0, "business_hour", _H),
    ("quarter_2", "load_daily", "Y", "ALL", "mart", "orders", "quarter", "2", 0, None, _D),
    ("quarter_4", "load_daily", "Y", "x", "mart", "raw_daily", "quarter", "4", 0, "business_date", _D),
    ("quarter_9", "load_daily", "Y", "ALL", "mart", "orders", "quarter", "9", 0, None, _D),
    ("mtd_4", "load_daily", "Y", "ALL", "mart", "orders", "month_to_date", "4", 0, None, _D),
    ("mtd_m", "load_monthly", "Y", "ALL", "mart", "orders", "month_to_date", "4", 0, None, _D),
    ("mtd_1", "load_monthly", "Y", "ALL", "mart", "orders", "month_to_date", "1", 0, None, _D),
    ("ytd_60", "load_daily", "Y", "x", "mart", "raw_daily", "year_to_date", "60", 0, "business_date", _D),
    ("ytd_5", "load_daily", "Y", "ALL", "mart", "orders", "year_to_date", "5", 0, None, _D),
    ("htd_5", "load_hourly", "Y", "x", "mart", "raw_hourly", "hour_to_date", "5", 0, "business_hour", _H),
    ("htd_log", "load_hourly", "Y", "click", "mart", "events", "hour_to_date", "2", 1, None, _H),
    ("period_d", "load_daily", "Y", "ALL", "mart", "orders", "daily_period", None, 0, None, _D),
    ("period_m", "load_monthly", "Y", "x", "mart", "raw_daily", "daily_period", None, 0, "business_date", _D),
    ("range_7", "load_daily", "Y", "ALL", "mart", "orders", "date_range", "7", 0, None, _D),
    ("range_30", "send_daily", "Y", "x", "mart", "raw_daily", "date_range", "30", 0, "business_date", _D),
    ("around_w", "load_weekly", "Y", "ALL", "mart", "orders", "date_in_range", "2", 0, None, _D),
    ("around_m", "load_monthly", "Y", "x", "mart", "raw_daily", "date_in_range", "1", 0, "business_date", _D),
    ("max_log", "load_daily", "Y", "4-not specified", "mart", "orders", "max_date", None, 4, None, _D),
    ("max_raw", "load_weekly", "Y", "x", "mart", "raw_daily", "max_date", None, 0, "business_date", _D),
    ("max_none", "load_daily", "Y", "nobody", "mart", "orders", "max_date", None, 0, None, _D),
    ("h24_log", "pull_hourly", "Y", "click", "mart", "events", "24hours", None, 0, None, _H),
    ("h24_raw", "pull_hourly", "Y", "x", "mart", "raw_hourly", "24hours", None, 0, "business_hour", _H),
    ("every_1", "pull_hourly", "Y", "error", "mart", "events", "every_n_hour", "1", 0, None, _H),
    ("every_2", "pull_hourly", "Y", "view", "mart", "events", "every_n_hour", "2", 4, None, _H),
    ("every_30", "pull_hourly", "Y", "nobody", "mart", "events", "every_n_hour", "30", 0, None, _H),
    ("every_0", "pull_hourly", "Y", "view", "mart", "events", "every_n_hour", "0", 0, None, _H),
    ("bad_check", "load_daily", "Y", "ALL", "mart", "orders", "hour_in_range", "1", 0, None, _D),
    ("bad_ingest", "pull_hourly", "Y", "view", "mart", "events", "weekly", "1", 0, None, _D),
    ("inactive", "load_daily", "N", "ALL", "mart", "orders", "daily", None, 0, None, _D),
]
DEPENDENCY_COLUMNS = {
    "dep_id": "string", "job_nm": "string", "active_flag": "string",
    "prerequisite_job_nm": "string", "prerequisite_schema_nm": "string",
    "prerequisite_table_nm": "string", "frequency_check": "string", "value": "string",
    "empty_flag": "int", "data_column": "string", "ictrl_dt_tgtfmt": "string",
}

# job_nm, job_type, date_start_job, total_delay, mode, flag; jobs are event types
DELAYS = [
    ("click", "Ingestion", "Every Tuesday", "3", "Week", "Y"),
    ("view", "ingestion", "sunday", "1", "week", "y"),
    ("error", "ingestion", "25", "4", "month", "Y"),
    ("purchase", "ingestion", "5", "2", "MONTH", "Y"),
    ("signup", "ingestion", "10", "2", "month", None),
    ("search", "ingestion", "monday", "2", "week", "n"),
    ("scroll", "ingestion", "monday", "2", "yearly", "Y"),
]
DELAY_COLUMNS = {
    "job_nm": "string", "job_type": "string", "date_start_job": "string",
    "total_delay": "string", "mode": "string", "flag": "string",
}

# folder, schema: a made-up mapping of return flags
FOLDER_SCHEMAS = [("R", "returns"), ("A", "accepted"), ("N", "pending")]
FOLDER_COLUMNS = {"folder_nm": "string", "schema_nm": "string"}

# dep_id, schema, table, workflow names (comma list or null)
WORKFLOW_DEPS = [
    ("any_1", "RETURNS", "T1", None),
    ("any_2", "accepted", "t2", None),
    ("some_3", "pending", "T3", "WF3,WF4,WF5"),
    ("one_4", "returns", "t4", "WF9"),
    ("none_5", "returns", "t5", "WF1"),
    ("lost_6", "nowhere", "t6", None),
]
WORKFLOW_DEP_COLUMNS = {
    "dep_id": "string", "schema_nm": "string", "table_nm": "string", "names": "string",
}

# rule_id, table, rule_calc, columns, expect_value, operation, sql_calc, arguments, margin_pct
RULES = [
    ("sum_qty", "lineitem", "SUM(l_quantity)", ["l_quantity"], 1.5e6, ">=", None, None, 5.0),
    ("sum_loss", "lineitem", "sum(-l_linenumber)", ["l_linenumber"], -240000.0, "==", None, None, 10.0),
    ("min_ship", "lineitem", "min(l_discount)", ["l_discount"], 0.0, "==", None, None, 0.0),
    ("min_qty", "lineitem", "Min(l_quantity)", ["l_quantity"], 1.0, ">", None, None, 0.0),
    ("max_tax", "lineitem", "max(l_tax)", ["l_tax"], 0.08, "<=", None, None, 0.0),
    ("max_line", "lineitem", "max(l_linenumber)", ["l_linenumber"], 7.0, "<", None, None, 50.0),
    ("avg_qty", "lineitem", "avg(l_quantity)", ["l_quantity"], 25.0, "==", None, None, 4.0),
    ("avg_price", "orders", "AVG(o_totalprice)", ["o_totalprice"], 1000.0, "<", None, None, 1.0),
    ("calc_net", "lineitem", "sum(net)", [], 1.0, ">=",
     "{0} * (100 - {1} * 100) / 100 AS net", ["tbl_name.l_quantity", "l_discount"], 0.0),
    ("calc_max", "orders", "max(k)", [], 14999.0, "==", "{0} AS k", ["o_orderkey"], 0.0),
    ("one_value", "order_count", "n", ["n"], 100.0, ">=", None, None, 0.0),
    ("many_rows", "orders", "o_custkey", ["o_custkey"], 1.0, "==", None, None, 0.0),
    ("bad_agg", "orders", "median(o_totalprice)", ["o_totalprice"], 1.0, "==", None, None, 0.0),
    ("bad_op", "orders", "max(o_orderkey)", ["o_orderkey"], 1.0, "!=", None, None, 0.0),
]


def frame(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    return spark.sql(values_sql(rows, columns))


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    return repr(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def values_sql(rows: list[tuple], columns: dict[str, str]) -> str:
    """The rows as a typed SELECT, valid in Spark and in the oracles' SQL."""
    body = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    casts = ", ".join(f"CAST({n} AS {t.upper()}) AS {n}" for n, t in columns.items())
    return f"SELECT {casts} FROM (VALUES {body}) AS v({', '.join(columns)})"
