"""The views of ``views.py`` written again in SQL, for the oracles."""

from __future__ import annotations

from tidemark.workload import control

PATTERNS = sorted(
    {job[6] for job in control.JOBS} | {dep[10] for dep in control.DEPENDENCIES}
    | {"%Y%m%d", "%Y-%m-%d", "%d/%m/%Y"}
)


def fmt(ts: str, pattern: str) -> str:
    """strftime by a pattern column: DuckDB wants the pattern constant, so one CASE arm each."""
    arms = " ".join(f"WHEN '{p}' THEN strftime({ts}, '{p}')" for p in PATTERNS)
    return f"CASE {pattern} {arms} END"


def parsed(label: str, pattern: str) -> str:
    arms = " ".join(f"WHEN '{p}' THEN try_strptime({label}, '{p}')" for p in PATTERNS)
    return f"CASE {pattern} {arms} END"


_LAGGED = (
    "r.ref_ts - to_days(CASE WHEN frequency = 'monthly' THEN 95 WHEN clock = 'events' THEN 1 ELSE 9 END)"
)
CTES = {
    "order_log": """
        SELECT CASE WHEN o_orderkey % 2 = 1 THEN 'ingest' ELSE 'trans' END AS log_kind,
               o_orderpriority AS job_nm, 'grp' || (o_custkey % 3) AS tasksgroup_nm,
               'mart' AS schema_nm, 'orders' AS table_nm,
               CAST(o_orderkey AS VARCHAR) AS dag_run_id,
               o_orderdate + to_seconds(o_orderkey) AS round_time,
               o_orderdate + to_seconds(o_orderkey) AS job_start_time,
               o_orderdate + to_seconds(o_orderkey) + to_seconds(o_custkey * 97) AS job_end_time,
               strftime(o_orderdate, '%Y%m%d') AS ictrl_dt,
               CASE o_orderstatus WHEN 'F' THEN 'SUCCEED' WHEN 'O' THEN 'RUNNING'
                                  ELSE 'FAILED' END AS status,
               o_custkey % 5 AS row_cnt
        FROM orders""",
    "audit_log": """
        SELECT log_kind, job_nm, schema_nm, table_nm, dag_run_id, round_time, job_start_time,
               ictrl_dt, status, row_cnt FROM order_log
        UNION ALL
        SELECT log_kind, 'ALL', schema_nm, table_nm, dag_run_id, round_time, job_start_time,
               ictrl_dt, status, row_cnt FROM order_log
        UNION ALL
        SELECT 'ingest', event_type, 'mart', 'events', 'e' || event_id, ts, ts,
               strftime(ts, '%Y%m%d%H'),
               CASE WHEN value > 5 THEN 'SUCCESS' ELSE 'FAILED' END, user_id % 5
        FROM events""",
    "raw_observed": """
        SELECT DISTINCT 'raw_daily' AS table_nm, 'business_date' AS data_column,
               strftime(o_orderdate, '%Y%m%d') AS label FROM orders
        UNION ALL
        SELECT DISTINCT 'raw_hourly', 'business_hour', strftime(ts, '%Y%m%d%H') FROM events""",
    "jobs": control.values_sql(control.JOBS, control.JOB_COLUMNS),
    "deps": control.values_sql(control.DEPENDENCIES, control.DEPENDENCY_COLUMNS),
    "refs": """
        SELECT DISTINCT 'orders' AS clock, o_orderdate AS ref_ts FROM orders
        UNION ALL
        SELECT DISTINCT 'events', date_trunc('hour', ts) FROM events""",
    "freq_rows": """
        SELECT o_orderkey, o_orderdate AS ts,
               ['15m','2h','hourly','daily','weekly','monthly','quarterly','yearly','']
                   [o_orderkey % 9 + 1] AS frequency,
               o_custkey % 4 AS n,
               ['%Y%m%d','%Y-%m-%d','%d/%m/%Y'][o_orderkey % 3 + 1] AS pattern
        FROM orders""",
    "job_starts": f"""
        SELECT j.*, r.ref_ts AS start_time,
               CASE WHEN day(r.ref_ts) % 5 <> 0 THEN {fmt(_LAGGED, 'ictrl_dt_tgtfmt')}
               END AS last_success_ictrl_dt,
               CASE WHEN day(r.ref_ts) % 7 = 0 THEN
                 {fmt('r.ref_ts - to_days(1)', 'ictrl_dt_tgtfmt')} END AS fixed_date
        FROM jobs j JOIN refs r USING (clock)""",
}


def with_views(names: str, query: str) -> str:
    """``query`` preceded by the named views, in the order of ``CTES``."""
    wanted = names.split()
    parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in wanted]
    body = query.strip()
    joiner = ", " if body.startswith("WITH ") else " "
    return "WITH RECURSIVE " + ", ".join(parts) + joiner + (body[5:] if joiner == ", " else body)
