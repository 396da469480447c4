"""Explicit schemas of the control tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

JOBS = """
    job_nm string, tasksgroup_nm string, job_type string, active_flag string,
    frequency string, back_day string, overlap string, catchup_type string,
    ictrl_dt_tgtfmt string, last_success_ictrl_dt string, schema_nm string,
    table_nm string, load_type string, partition_column string, unique_key string,
    update_condition string, update_column string, cdr_flag string, ingestion_type string
"""

DEPENDENCIES = """
    dep_id string, job_nm string, active_flag string, prerequisite_job_nm string,
    prerequisite_schema_nm string, prerequisite_table_nm string, frequency_check string,
    value string, empty_flag int, data_column string, ictrl_dt_tgtfmt string
"""

AUDIT_LOG = """
    log_kind string, job_nm string, tasksgroup_nm string, schema_nm string, table_nm string,
    dag_run_id string, load_type string, round_time timestamp_ntz,
    job_start_time timestamp_ntz, job_end_time timestamp_ntz, ictrl_dt string,
    start_ictrl_dt string, end_ictrl_dt string, pattern_ictrl_dt string, status string,
    row_cnt bigint, source_cnt bigint, process_cnt bigint, err_msg string, log_url string,
    duration string, app_id string
"""

DELAYS = """
    job_nm string, job_type string, date_start_job string, total_delay string,
    mode string, flag string
"""

VALIDATION_RULES = """
    rule_id string, table string, rule_calc string, apply_cols array<string>,
    expect_value double, operation string, sql_calc string,
    sql_calc_apply array<string>, margin_pct double
"""

# Job types; every type but the first two ingests.
TRANSFORM_TYPES = ("transform", "outbound")
INGEST_TYPES = ("ingestApi", "ingestDb", "file", "kafka")
JOB_TYPE_PRIORITY = TRANSFORM_TYPES + INGEST_TYPES

# Run states; both spellings of success count as succeeded.
SUCCEEDED = ("SUCCEED", "SUCCESS")
RUNNING = "RUNNING"
FAILED = "FAILED"


def conform(df: DataFrame, schema: str) -> DataFrame:
    """A control table with exactly the schema's columns, in its types; absent ones are null."""
    present = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(present[f.name.lower()]) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in StructType.fromDDL(schema).fields
    ])
