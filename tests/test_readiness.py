"""Expected dates and verdicts on literal rows."""

from __future__ import annotations

import random
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import labels
from tidemark.operators import readiness as rd
from tidemark.operators import loads, raw_dates, workflow
from tidemark.plans import run_plan

CHECK = ("dep_id string, job_nm string, consumer string, prerequisite_job_nm string, "
         "prerequisite_schema_nm string, prerequisite_table_nm string, frequency_check string, "
         "value string, empty_flag int, data_column string, pattern string, frequency string, "
         "back_day string, start_ts timestamp_ntz, ref_ts timestamp_ntz")
LOG = ("log_kind string, job_nm string, schema_nm string, table_nm string, dag_run_id string, "
       "round_time timestamp_ntz, job_start_time timestamp_ntz, ictrl_dt string, status string, "
       "row_cnt bigint")


def check(dep, kind, value, ref, consumer="transform", frequency="daily", pattern="%Y%m%d",
          empty_flag=0, column=None, start=None, job="up", table="t", back_day=None):
    return (dep, "down", consumer, job, "s", table, kind, value, empty_flag, column, pattern,
            frequency, back_day, start, ref)


def frame(spark, checks):
    return spark.createDataFrame(checks, CHECK).withColumns({
        "label_pattern": F.expr(labels.spark_pattern("pattern")),
        "job_label_pattern": F.lit("yyyyMMdd"),
    })


def log(kind, label, status, rows, hour=1, job="UP", table="t", run="r"):
    t = datetime(2024, 1, 1, hour)
    return (kind, job, "s", table, run, t, t, label, status, rows)


@pytest.mark.parametrize(("kind", "value", "ref", "extra", "expected"), [
    ("weekly", "0", datetime(2024, 1, 10), {}, ["20240107"]),
    ("weekly", "3", datetime(2024, 1, 10), {}, ["20240110"]),
    ("weekly", None, datetime(2024, 1, 7), {}, ["20240107"]),
    ("cur_month", "15", datetime(2024, 1, 10), {}, ["20240115"]),
    ("prev_month", "29", datetime(2024, 3, 31), {}, ["20240229"]),
    ("eom", None, datetime(2024, 3, 15), {}, ["20240229"]),
    ("day-n", "2", datetime(2024, 3, 1), {}, ["20240228"]),
    ("quarter", "4", datetime(2024, 5, 10), {}, ("20231001", "20231231", 92)),
    ("quarter", "1", datetime(2024, 5, 10), {}, ("20240101", "20240331", 91)),
    ("quarter", "2", datetime(2024, 5, 10), {}, ("20240401", "20240510", 40)),
    ("month_to_date", "3", datetime(2024, 5, 10), {}, ["20240501", "20240502", "20240503"]),
    ("month_to_date", "3", datetime(2024, 5, 10), {"frequency": "monthly"}, ["20240501", "20240502"]),
    ("month_to_date", "3", datetime(2024, 5, 10), {"frequency": "monthly", "back_day": "1"},
     ["20240501", "20240502", "20240503"]),
    ("year_to_date", "3", datetime(2024, 5, 10), {}, ["20240101", "20240102", "20240103"]),
    ("date_range", "2", datetime(2024, 1, 1), {}, ["20231230", "20231231", "20240101"]),
    ("date_in_range", "1", datetime(2024, 3, 31), {"frequency": "monthly"},
     ["20240229", "20240331", "20240430"]),
    ("daily_period", None, datetime(2024, 3, 30), {"frequency": "monthly", "start": datetime(2024, 1, 31)},
     ["20240131", "20240229", "20240329"]),
    ("hour_to_date", "1", datetime(2024, 1, 1, 9, 30), {"pattern": "%Y%m%d%H%M"},
     ["202401010000", "202401010100"]),
    # daily dates under a monthly label are one label
    ("date_range", "2", datetime(2024, 1, 10), {"pattern": "%Y%m"}, ["202401"]),
])
def test_expected_labels(spark, kind, value, ref, extra, expected):
    checks = frame(spark, [check("d", kind, value, ref, **extra)])
    got = rd.expected_labels(rd.prepare(checks)).filter("route = 'trans'").select("label").distinct()
    found = sorted(r.label for r in got.collect())
    if isinstance(expected, tuple):
        assert (found[0], found[-1], len(found)) == expected
    else:
        assert found == expected


def verdict(spark, checks, logs, raw=None):
    rows = rd.readiness(
        frame(spark, checks), spark.createDataFrame(logs, LOG), raw
    ).collect()
    return {r.dep_id: (r.ready, r.missing, r.reason) for r in rows}


REF = datetime(2024, 1, 10)


def test_latest_against_missing(spark):
    logs = [log("trans", "20240110", "SUCCEED", 5, 1), log("trans", "20240110", "FAILED", 5, 2),
            log("trans", "20240109", "SUCCESS", None, 1)]
    got = verdict(spark, [
        check("latest", "daily", None, REF),
        check("set", "date_range", "0", REF),
        check("null_0", "day-n", "1", REF),
        check("null_1", "day-n", "1", REF, empty_flag=1),
        check("two", "date_range", "2", REF),
        check("bad_day", "cur_month", "31", datetime(2023, 2, 10)),
        check("bad_quarter", "quarter", "7", REF),
        check("no_window", "year_to_date", "0", REF),
        check("unsupported", "fortnightly", None, REF),
        check("bad_pattern", "daily", None, REF, pattern="%Q"),
        check("bad_frequency", "date_in_range", "1", REF, frequency="often"),
    ], logs)
    assert got["latest"] == (False, ["20240110"], "missing")
    assert got["set"] == (True, [], None)
    assert got["null_0"][0] is True
    assert got["null_1"] == (False, ["20240109"], "missing")
    # the ingest log, asked last, tells what is missing
    assert got["two"] == (False, ["20240108", "20240109", "20240110"], "missing")
    assert got["bad_day"] == (False, [], "invalid_value")
    assert got["bad_quarter"] == (False, [], "invalid_value")
    assert got["no_window"] == (False, [], "empty_window")
    assert got["unsupported"] == (False, [], "unsupported")
    assert got["bad_pattern"] == (False, [], "invalid_pattern")
    assert got["bad_frequency"] == (False, [], "invalid_frequency")


def test_tie_is_broken_by_round_then_run(spark):
    t = datetime(2024, 1, 1)
    later = datetime(2024, 1, 1, 1)
    logs = [("trans", "UP", "s", "t", "b", t, t, "20240110", "SUCCEED", 1),
            ("trans", "UP", "s", "t", "a", later, t, "20240110", "FAILED", 1)]
    assert verdict(spark, [check("d", "daily", None, REF)], logs)["d"][0] is False


def test_two_logs_and_prefix(spark):
    logs = [log("ingest", "20240110", "SUCCEED", 1), log("ingest", "2024011007", "FAILED", 1, 1, "HOURS"),
            log("ingest", "2024011008", "SUCCEED", 3, 2, "HOURS")]
    got = verdict(spark, [
        check("fallback", "daily", None, REF),
        check("ingest_only", "daily", None, REF, consumer="ingest"),
        check("prefix", "daily", None, REF, consumer="ingest", job="hours"),
        check("prefix_many", "daily", None, REF, consumer="ingest", job="hours", empty_flag=4),
        check("exact", "daily", None, REF, job="hours"),
        check("table_words", "daily", None, REF, consumer="ingest", table="t alias"),
    ], logs)
    assert {k for k, v in got.items() if v[0]} == {"fallback", "ingest_only", "prefix", "table_words"}
    assert got["exact"][1] == ["20240110"]


def test_tolerant_hours(spark):
    hours = [log("ingest", f"20240110{h:02d}", "SUCCEED", 1) for h in range(4)]
    failed = [log("ingest", "2024011000", "FAILED", 1, 1, "BAD")]

    def every(dep, n, job="up"):
        return check(dep, "every_n_hour", n, REF, consumer="ingest", pattern="%Y%m%d%H", job=job)

    got = verdict(spark, [
        every("n5", "5"), every("n6", "6"), every("n4", "4"), every("n1", None), every("n0", "0"),
        every("n30", "30", "bad"), every("n30_none", "30", "nobody"),
        check("all", "24hours", None, REF, consumer="ingest", pattern="%Y%m%d%H"),
    ], hours + failed)
    assert {k for k, v in got.items() if v[0]} == {"n5", "n6", "n30"}  # 24 div 5 = 4 hours
    assert got["n0"][2] == "invalid_value"
    assert len(got["n4"][1]) == len(got["all"][1]) == 20
    assert len(got["n30_none"][1]) == 24


def test_raw_and_newest(spark):
    raw = spark.createDataFrame([("s", "t", "day", "20240110"), ("s", "t", "day", "20240109")],
                                "schema_nm string, table_nm string, data_column string, label string")
    logs = [log("trans", "20240111", "SUCCEED", 2), log("trans", "20240115", "FAILED", 2),
            log("trans", "soon", "SUCCEED", 2)]
    got = verdict(spark, [
        check("raw", "daily", None, REF, column="day"),
        check("raw_range", "date_range", "2", REF, column="day"),
        check("raw_max", "max_date", None, datetime(2024, 1, 11), column="day"),
        check("none_text", "daily", None, REF, column="None", consumer="ingest"),
        check("max", "max_date", None, datetime(2024, 1, 11), empty_flag=2),
        check("max_rows", "max_date", None, datetime(2024, 1, 11), empty_flag=3),
        check("max_late", "max_date", None, datetime(2024, 1, 12)),
    ], logs, raw)
    assert {k for k, v in got.items() if v[0]} == {"raw", "max"}
    assert got["raw_range"][1] == ["20240108"]
    assert got["raw_max"][1] == ["20240111"]
    assert got["max_late"][1] == ["20240112"]


def test_mixed_patterns_still_prune_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    logs = [log("trans", "20240110", "SUCCEED", 1), log("trans", "2024-01-10", "SUCCEED", 1, job="ISO"),
            log("trans", "20230101", "SUCCEED", 1)]
    spark.createDataFrame(logs, LOG).write.parquet(str(tmp_path / "log"))
    table = spark.read.parquet(str(tmp_path / "log"))
    checks = [check("a", "daily", None, REF), check("b", "date_range", "3", REF, pattern="%Y-%m-%d", job="iso")]
    relevant = rd.relevance(rd.prepare(frame(spark, checks)))
    assert sorted(relevant.patterns) == [("2024-01-07", "2024-01-10"), ("20240110", "20240110")]
    rows = relevant.of_log(table)
    pushed = rows._jdf.queryExecution().executedPlan().toString().split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(ictrl_dt,20240110)" in pushed and "2024-01-07" in pushed
    assert sorted(r.ictrl_dt for r in rows.collect()) == ["2024-01-10", "20240110"]
    assert verdict(spark, checks, logs)["a"][0] is True
    # a pattern that does not sort by time leaves the scan open, not the sources
    mixed = [*checks, check("c", "daily", None, REF, pattern="%d/%m/%Y", job="other")]
    open_scan = rd.relevance(rd.prepare(frame(spark, mixed)))
    assert open_scan.patterns is None
    assert sorted(r.ictrl_dt for r in open_scan.of_log(table).collect()) == ["2024-01-10", "20240110"]


def test_only_raw_tables_and_ranges_asked_for_are_read(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    days = spark.createDataFrame([(d,) for d in ("2024-01-08", "2024-01-09", "2024-01-10", "2023-05-05")], "day string")
    kinds = {"t": F.col("day").cast("date"), "u": F.regexp_replace("day", "-", "").cast("int"), "v": F.col("day")}
    tables = {}
    for name, column in kinds.items():
        days.select(column.alias("day")).write.parquet(str(tmp_path / name))
        tables["s", name, "day"] = spark.read.parquet(str(tmp_path / name))
    checks = [check("t", "date_range", "1", REF, column="day", pattern="%Y-%m-%d"),
              check("u", "date_range", "1", REF, column="day", table="u")]
    relevant = rd.relevance(rd.prepare(frame(spark, checks)))
    plan = relevant.of_raw(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") + plan.count("FileScan parquet") >= 2 and f"{tmp_path}/v" not in plan
    assert "GreaterThanOrEqual(day,2024-01-09)" in plan and "GreaterThanOrEqual(day,20240109)" in plan
    assert sorted((r.table_nm, r.label) for r in relevant.of_raw(tables).collect()) == [
        ("t", "2024-01-09"), ("t", "2024-01-10"), ("u", "20240109"), ("u", "20240110")]
    assert {k: v[0] for k, v in verdict(spark, checks, [], tables).items()} == {"t": True, "u": True}
    nothing = rd.relevance(rd.prepare(frame(spark, [check("log", "daily", None, REF)])))
    assert nothing.of_raw(tables) is None


def test_coarse_labels_are_distinct(spark):
    checks = frame(spark, [check("d", "date_range", "90", REF, pattern="%Y%m"), check("h", "hour_to_date", "5", REF)])
    got = rd.expected_labels(rd.prepare(checks)).filter("route = 'trans'").select("dep_id", "label").collect()
    assert sorted(map(tuple, got)) == [("d", "202310"), ("d", "202311"), ("d", "202312"), ("d", "202401"), ("h", "20240110")]


def test_newest_serves_many_dependencies_of_one_source(spark):
    logs = [log("trans", f"2023{m:02d}{d:02d}", "SUCCEED", m, run=f"{m}-{d}") for m in range(1, 13) for d in range(1, 29)]
    checks = [check(f"d{i}", "max_date", None, datetime(2023, 12, 28), empty_flag=i % 14) for i in range(60)]
    prepared = rd.prepare(frame(spark, checks))
    found = rd.newest_succeeded(prepared, rd.log_facts(spark.createDataFrame(logs, LOG))).collect()
    assert len(found) == 60 - len([i for i in range(60) if i % 14 == 13])
    assert {r.newest_ts for r in found} == {datetime(2023, 12, 28)}


def test_job_rollup(spark):
    runs = spark.createDataFrame([("a", REF), ("b", REF)], "job_nm string, ref_ts timestamp_ntz")
    verdicts = spark.createDataFrame(
        [("a", REF, "p", True), ("a", REF, "q", False), ("a", REF, "q", True)],
        "job_nm string, ref_ts timestamp_ntz, prerequisite_job_nm string, ready boolean")
    got = {r.job_nm: (r.ready, r.not_ready) for r in rd.job_rollup(runs, verdicts).collect()}
    assert got == {"a": (False, ["q"]), "b": (True, [])}


def test_range_or_set(spark):
    table = spark.createDataFrame(
        [("%Y%m%d", "20240105"), ("%Y%m%d", "20240205"), ("%d/%m/%Y", "05/01/2024")],
        "pattern string, label string")
    wanted = spark.createDataFrame(
        [("d", "%Y%m%d", "20240101"), ("d", "%Y%m%d", "20240301"),
         ("e", "%d/%m/%Y", "01/01/2024"), ("e", "%d/%m/%Y", "05/01/2024")],
        "dep_id string, pattern string, label string")
    got = raw_dates.range_or_set_scan(table, "label", wanted).select("dep_id", "label").collect()
    assert sorted(map(tuple, got)) == [("d", "20240105"), ("d", "20240205"), ("e", "05/01/2024")]


def test_workflow_without_writer_is_not_ready(spark):
    day = datetime(2024, 1, 10)
    writes = spark.createDataFrame(
        [("f", "w1", "T", "AUTO", 0), ("f", "w2", "T", "AUTO", 0), ("f", "w3", "T", "AUTO", 1)],
        "folder_nm string, workflow_nm string, tgt_obj string, workflow_type string, obs_ind int")
    history = spark.createDataFrame(
        [("f", "w1", "Succeeded", day), ("f", "w2", "Failed", day)],
        "folder_nm string, workflow_nm string, stat string, xtr_end_dt timestamp_ntz")
    completions = workflow.last_completions(
        writes, history, spark.createDataFrame([("f", "S")], "folder_nm string, schema_nm string"),
        spark.createDataFrame([("MANUAL",)], "workflow_type string"),
        spark.createDataFrame([("x",)], "workflow_nm string"))
    deps = spark.createDataFrame(
        [("all", "s", "t", None), ("w1", "s", "t", ["w1"]), ("lost", "s", "u", None)],
        "dep_id string, schema_nm string, table_nm string, names array<string>")
    targets = deps.select("dep_id", F.lit(day.date()).alias("target_day"))
    got = {r.dep_id: r.ready for r in workflow.workflow_complete(deps, targets, completions).collect()}
    assert got == {"all": False, "w1": True, "lost": False}


def test_nameless_daily_ingest_asks_the_workflows(spark):
    completions = spark.createDataFrame(
        [("S", "T", "w1", datetime(2024, 1, 10).date()), ("S", "T", "w2", datetime(2024, 1, 12).date()),
         ("S", "U", "w3", None)],
        "schema_key string, table_key string, workflow_nm string, last_day date")
    checks = frame(spark, [
        check("done", "daily", None, datetime(2024, 1, 10, 9), consumer="ingest", job=None),
        check("late", "daily", None, datetime(2024, 1, 11), consumer="ingest", job="none"),
        check("never", "daily", None, REF, consumer="ingest", job="", table="u"),
        check("nobody", "daily", None, REF, consumer="ingest", job="", table="v"),
        check("by_log", "daily", None, REF, job=""),
    ])
    rows = rd.readiness(checks, spark.createDataFrame([], LOG), None, completions).collect()
    assert {r.dep_id: r.ready for r in rows} == {
        "done": True, "late": False, "never": False, "nobody": False, "by_log": False}


def test_run_plan(spark):
    now = datetime(2024, 1, 10, 6)
    jobs = spark.createDataFrame(
        [("down", "transform", "daily", "0", None, "sequence", "%Y%m%d", "N", "20240107", now),
         ("free", "ingestDb", "daily", "0", None, None, "%Y%m%d", "N", None, now)],
        "job_nm string, job_type string, frequency string, back_day string, overlap string, "
        "catchup_type string, ictrl_dt_tgtfmt string, cdr_flag string, last_success_ictrl_dt string, "
        "start_time timestamp_ntz")
    deps = spark.createDataFrame(
        [("d", "down", "Y", "up", "s", "t", "daily", None, 0, None, "%Y%m%d"),
         ("off", "down", "N", "gone", "s", "t", "daily", None, 0, None, "%Y%m%d")],
        "dep_id string, job_nm string, active_flag string, prerequisite_job_nm string, "
        "prerequisite_schema_nm string, prerequisite_table_nm string, frequency_check string, "
        "value string, empty_flag int, data_column string, ictrl_dt_tgtfmt string")
    logs = [log("trans", "20240108", "SUCCEED", 1), log("ingest", "20240110", "SUCCEED", 1)]
    runs = run_plan.planned(jobs)
    result = run_plan.run_readiness(runs, deps, spark.createDataFrame(logs, LOG))
    got = {(r.job_nm, r.ictrl_dt): (r.ready, r.not_ready) for r in result.collect()}
    assert got == {("down", "20240108"): (True, []), ("down", "20240109"): (False, ["up"]),
                   ("down", "20240110"): (True, []), ("free", "20240110"): (True, [])}

    started = datetime(2024, 1, 10, 5)
    busy = spark.createDataFrame(
        [("FREE", "g", started, started, "r0", "20240110", "RUNNING", None),
         ("down", "g", started, started, "r0", "20240108", "SUCCEED", "-")],
        "job_nm string, tasksgroup_nm string, round_time timestamp_ntz, job_start_time timestamp_ntz, "
        "dag_run_id string, ictrl_dt string, status string, err_msg string")
    candidates = result.withColumns({
        "tasksgroup_nm": F.lit("g"), "round_time": F.lit(now), "dag_run_id": F.lit("r1")})
    left = run_plan.startable(candidates, busy).select("job_nm", "ictrl_dt").collect()
    assert [tuple(r) for r in left] == [("down", "20240110")]


# --- the newest run without a sort ---------------------------------------------------------------


def test_facts_against_plain_rows(spark):
    rng = random.Random(6)
    times = [None, datetime(1969, 12, 31, 23), datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 1), datetime(9999, 12, 31)]
    logs = [(rng.choice(["trans", "ingest"]), rng.choice(["up", "UP", "b"]), rng.choice([None, "s"]), "t", rng.choice([None, "r1", "r2", "r10"]),
             rng.choice(times), rng.choice(times), rng.choice([None, "20240101", "20240102"]), rng.choice(["SUCCEED", "SUCCESS", "FAILED"]), rng.choice([None, 1, 5]))
            for _ in range(500)]
    logs = list({row[:8]: row for row in logs}.values())  # no run twice
    expected = {}
    for kind, name, schema, table, run, round_, start, label, status, n in logs:
        if label is None:
            continue
        fact = expected.setdefault((kind, name.upper(), schema, table, label), [None, None, None])
        rows = (n or 0) if status != "FAILED" else None
        order = [(x is not None, x) if x is not None else (False,) for x in (start, round_, run)]
        if rows is not None and (fact[0] is None or rows > fact[0]):
            fact[0] = rows
        if fact[2] is None or order > fact[2]:
            fact[1], fact[2] = rows, order
    got = rd.log_facts(spark.createDataFrame(logs, LOG)).collect()
    assert {(r.route, r.job_key, r.schema_nm, r.table_nm, r.label): [r.best_rows, r.latest_rows] for r in got} == {
        k: v[:2] for k, v in expected.items()}
    assert len(got) == len(expected)


def test_the_log_is_not_sorted(spark):
    plan = rd.newest_by_hash(spark.createDataFrame([log("trans", "20240101", "SUCCEED", 1)], LOG), ["SUCCEED"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text
    only = rd.newest_by_hash(spark.createDataFrame([log("trans", "20240101", "SUCCEED", i, run="same") for i in range(3)], LOG), ["SUCCEED"])
    several = rd.newest_by_hash(spark.createDataFrame([log("trans", "20240101", "SUCCEED", 1, run=r) for r in "ab"], LOG), ["SUCCEED"])
    assert not only.first().tied and several.first().tied


# --- read as little as can be -----------------------------------------------------------------


@pytest.fixture
def catalog(spark):
    made = []

    def make(df, partition_by=()):
        made.append(f"rd_{uuid.uuid4().hex[:10]}")
        loads.create_table(df, made[-1], partition_by)
        return made[-1]

    yield make
    for name in made:
        loads.drop_table(spark, name)


def files_read(df):
    """Files that the scans of a finished query read, by its own metrics."""
    df = df.select("*")  # a query of its own
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif hasattr(node, "plan") and node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        if "Scan" in node.nodeName() and node.metrics().contains("numFiles"):
            found += node.metrics().apply("numFiles").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_a_partitioned_log_is_read_where_it_is_asked(spark, catalog):
    logs = [log("trans", f"202401{d:02d}", "SUCCEED", 1, run=str(d)) for d in range(1, 32)] + [log("trans", None, "SUCCEED", 1)]
    whole = spark.createDataFrame(logs, LOG)
    name = catalog(whole, ["ictrl_dt"])
    checks = [check("a", "date_range", "2", REF), check("b", "daily", None, datetime(2024, 1, 20)), check("none", "daily", None, datetime(2023, 1, 1))]
    relevant = rd.relevance(rd.prepare(frame(spark, checks)))
    rows = relevant.of_log(*rd._log_and_labels(spark, name))
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.ictrl_dt for r in rows.collect()) == [f"202401{d:02d}" for d in range(1, 21)]
    assert files_read(rows) == 20 + 2  # partitions of the log from the first label to the last; labels and what is asked
    by_name = sorted(map(tuple, rd.readiness(frame(spark, checks), name).collect()), key=repr)
    assert by_name == sorted(map(tuple, rd.readiness(frame(spark, checks), whole).collect()), key=repr)
    only = rd.relevance(rd.prepare(frame(spark, checks[:1]))).of_log(*rd._log_and_labels(spark, name))
    assert sorted(r.ictrl_dt for r in only.collect()) == ["20240108", "20240109", "20240110"] and files_read(only) == 3 + 2


def test_dates_of_partitions_are_listed(spark, catalog):
    days = [("2024-01-08", "a"), ("2024-01-09", "b/+%= c"), (None, "b/+%= c"), ("2024-01-09", "d")]
    df = spark.createDataFrame(days, "day string, part string").select("*", F.col("day").cast("date").alias("on"), F.lit(1).alias("v"))
    name = catalog(df, ["part", "on"])
    for column in ("part", "on"):
        listed = raw_dates.business_dates(spark, name, column)
        plan = listed._jdf.queryExecution().executedPlan().toString()
        assert "Scan parquet" not in plan and "FileScan" not in plan and "ShowPartitions" in plan
        assert set(listed.collect()) == set(df.select(column).distinct().collect())
        assert dict(listed.dtypes) == {column: dict(df.dtypes)[column]}
    listed = raw_dates.business_dates(spark, name, "on")
    day = F.lit("2024-01-09").cast("date")
    assert [r[0].day for r in raw_dates.dates_equal(listed, "on", day).collect()] == [9]
    assert [r[0].day for r in raw_dates.dates_from(listed, "on", day).collect()] == [9]
    assert raw_dates.dates_between(listed, "on", F.lit("2024-01-01").cast("date"), day).count() == 2
    assert raw_dates.business_dates(spark, name, "v").distinct().count() == 1  # no partition column: the file is read
    checks = frame(spark, [check("r", "date_range", "1", datetime(2024, 1, 9), column="on", pattern="%Y-%m-%d"),
                           check("m", "max_date", None, datetime(2024, 1, 9), column="on", pattern="%Y-%m-%d")])
    got = rd.readiness(checks, spark.createDataFrame([], LOG), {("s", "t", "on"): name}).collect()
    assert all(r.ready for r in got) and len(got) == 2


def test_the_newest_date_comes_from_statistics(spark, catalog):
    days = spark.createDataFrame([("2024-01-08",), ("2024-01-11",), (None,)], "day string")
    kinds = {"d": F.col("day").cast("date"), "i": F.regexp_replace("day", "-", "").cast("int"), "s": F.col("day")}
    name = catalog(days.select(*[c.alias(n) for n, c in kinds.items()]).coalesce(1))
    for column in ("d", "i"):
        newest = raw_dates.newest_from_statistics(spark, name, column)
        assert f"PushedAggregation: [MAX({column})]" in newest._jdf.queryExecution().executedPlan().toString()
        assert newest.first()[0] == spark.table(name).agg(F.max(column)).first()[0]
    assert raw_dates.newest_from_statistics(spark, name, "s") is None  # text has no whole statistics
    patterns = {"d": "%Y-%m-%d", "i": "%Y%m%d", "s": "%Y-%m-%d"}
    checks = [check(f"{c}{d}", "max_date", None, datetime(2024, 1, d), column=c, pattern=p) for c, p in patterns.items() for d in (11, 12)]
    tables = {("s", "t", c): name for c in patterns}
    empty = spark.createDataFrame([], LOG)
    relevant = rd.relevance(rd.prepare(frame(spark, checks)))
    assert sorted((r.data_column, r.label) for r in relevant.of_raw(tables).collect()) == [("d", "2024-01-11"), ("i", "20240111"), ("s", "2024-01-11")]
    by_name = {r.dep_id: r.ready for r in rd.readiness(frame(spark, checks), empty, tables).collect()}
    by_rows = {r.dep_id: r.ready for r in rd.readiness(frame(spark, checks), empty, {k: spark.table(name) for k in tables}).collect()}
    assert by_name == by_rows == {f"{c}{d}": d == 11 for c in patterns for d in (11, 12)}
    # a file without statistics is read
    nulls = catalog(spark.createDataFrame([("2024-01-11",), (None,)], "day string").select(F.col("day").cast("date").alias("d")).repartition(2, "d"))
    assert raw_dates.newest_label(spark, nulls, "d", ["yyyy-MM-dd"]) in (None, "2024-01-11")
    checks = frame(spark, [check("d", "max_date", None, datetime(2024, 1, 11), column="d", pattern="%Y-%m-%d")])
    assert rd.readiness(checks, empty, {("s", "t", "d"): nulls}).first().ready
    # a value that is no date in the pattern is not taken for one
    odd = catalog(spark.createDataFrame([(20240111,), (99999999,)], "i int"))
    checks = frame(spark, [check("i", "max_date", None, datetime(2024, 1, 11), column="i"), check("j", "max_date", None, datetime(2024, 1, 12), column="i")])
    got = {r.dep_id: r.ready for r in rd.readiness(checks, empty, {("s", "t", "i"): odd}).collect()}
    assert got == {"i": True, "j": False}
