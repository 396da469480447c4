"""Rules, run results, audit folding, encryption and typed sources on literal rows."""

from __future__ import annotations

import itertools
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import security
from tidemark.operators import audit, validation
from tidemark.operators.validation import Rule
from tidemark.sources import jdbc
from tidemark.sources.key_value import wide_rows


@pytest.mark.parametrize(("value", "expect", "operation", "margin", "result"), [
    (95.0, 100.0, ">=", 5.0, True), (95.0, 100.0, ">", 5.0, False), (95.0, 100.0, "==", 5.0, True),
    (105.0, 100.0, "<=", 5.0, True), (105.0, 100.0, "<", 5.0, False), (106.0, 100.0, "==", 5.0, False),
    (-100.0, -100.0, "==", 5.0, True), (-104.0, -100.0, ">=", 5.0, True), (1.0, 1.0, "!=", 0.0, None),
])
def test_tolerance(spark, value, expect, operation, margin, result):
    verdict = validation.within_tolerance(*map(F.lit, (value, expect, operation, margin)))
    assert spark.range(1).select(verdict.alias("v")).first().v is result


def test_rules_share_one_scan(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 4.0)], "a int, b double")
    rules = [
        Rule("sum", "t", "SUM(a)", ("a",), 4, "=="), Rule("max", "t", "max(b - a)", ("a", "b"), 1, "<="),
        Rule("none", "t", "min(nullif(a, a))", ("a",), 1, "=="), Rule("bad", "t", "mode(a)", ("a",), 1, "=="),
        Rule("many", "t", "a", ("a",), 1, "=="), Rule("op", "t", "avg(a)", ("a",), 1, "~"),
        Rule("calc", "t", "sum(c)", (), 14, "==", "{0} * {1} AS c", ("tbl_name.a", "b")),
    ]
    result = validation.evaluate(rules, {"t": df})
    got = {r.rule_id: (r.value, r.is_valid, r.reason) for r in result.collect()}
    assert got["sum"] == (4.0, True, None)
    assert got["max"] == (1.0, True, None)
    assert got["none"] == (None, False, "no value")
    assert got["bad"][1:] == (False, "unsupported aggregate: mode")
    assert got["many"][1:] == (False, "needs exactly one row")
    assert got["op"] == (2.0, False, "unsupported operation: ~")
    assert got["calc"] == (14.0, True, None)


def test_rules_from_a_table_on_a_qualified_name(spark):
    rules = [("calc", "mart.sales", "sum(c)", None, 14.0, "==", "{0} * {1} AS c", ["tbl_name.a", "b"], None),
             ("plain", "mart.sales", "max(a)", ["a"], 3.0, "==", None, None, 0.0)]
    table = spark.createDataFrame(rules, schemas.VALIDATION_RULES).drop("margin_pct")
    df = spark.createDataFrame([(1, 2.0), (3, 4.0)], "a int, b double")
    views = len(spark.catalog.listTables())
    got = {r.rule_id: r.is_valid for r in validation.evaluate(validation.rules_of(table), {"mart.sales": df}).collect()}
    assert got == {"calc": True, "plain": True}
    assert len(spark.catalog.listTables()) == views


def test_an_item_without_a_status_has_failed(spark):
    items = spark.createDataFrame([(1, "SUCCESS"), (1, None)], "run_id int, status string")
    row = validation.group_result(items).first()
    assert (row.status, row.error_cnt, row.message) == ("FAILED", 1, "There is error on 1 of 2 items: none=1")


def test_group_result(spark):
    items = spark.createDataFrame(
        [(1, "SUCCESS"), (1, "FAILED"), (1, "ABORT"), (1, "FAILED"), (2, "SUCCESS")], "run_id int, status string")
    got = {r.run_id: (r.status, r.message) for r in validation.group_result(items).collect()}
    assert got == {1: ("FAILED", "There is error on 3 of 4 items: ABORT=1, FAILED=2"), 2: ("SUCCESS", "")}


def test_duration_exceeds_a_day(spark):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([(start, start + timedelta(seconds=104_767))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(audit.duration(F.col("a"), F.col("b"))).first()[0] == "29:06:07"


EVENT = ("log_kind string, job_nm string, tasksgroup_nm string, round_time timestamp_ntz, dag_run_id string, "
         "status string, row_cnt bigint, ictrl_dt string, job_start_time timestamp_ntz, deleted boolean, "
         "event_time timestamp_ntz")


def event(run, hour, status=None, rows=None, deleted=None):
    day = datetime(2024, 1, 1)
    return ("trans", "j", "g", day, run, status, rows, f"2024010{run}", day, deleted, day + timedelta(hours=hour))


def test_fold_is_independent_of_order(spark):
    events = [event("1", 1, "RUNNING"), event("1", 2, "SUCCESS", 5), event("1", 3, None, 7),
              event("2", 1, "RUNNING"), event("2", 2, None, None, True),
              event("3", 1, "FAILED"), event("3", 2, None, None, True), event("3", 3, "SUCCESS", 1)]
    for order in itertools.islice(itertools.permutations(events), 0, 40000, 8000):
        state = audit.fold(spark.createDataFrame(order, EVENT), ["status", "row_cnt"])
        got = {r.dag_run_id: (r.status, r.row_cnt) for r in state.collect()}
        assert got == {"1": ("SUCCESS", 7), "3": ("SUCCESS", 1)}


def test_fold_of_events_at_the_same_time(spark):
    day = datetime(2024, 1, 1)
    at = lambda status, duration=None, rows=None: (
        "trans", "j", "g", day, "1", status, rows, "20240101", day, duration, day)
    events = [at("RUNNING"), at("SUCCESS", "00:00:00", 3), at("FAILED"), at("RUNNING")]
    schema = EVENT.replace("deleted boolean", "duration string")
    for order in itertools.permutations(events):
        row = audit.fold(spark.createDataFrame(order, schema).coalesce(1), ["status", "row_cnt"]).first()
        assert (row.status, row.row_cnt) == ("SUCCESS", 3)


def test_watermark_takes_the_last_success(spark):
    events = spark.createDataFrame(
        [event("1", 1, "SUCCESS"), event("2", 1, "SUCCESS"), event("3", 1, "FAILED")], EVENT)
    jobs = spark.createDataFrame([("j", "20230101"), ("k", "20230101")], "job_nm string, last_success_ictrl_dt string")
    got = dict(map(tuple, audit.advance_watermark(jobs, events).collect()))
    assert got == {"j": "20240102", "k": "20230101"}


def test_encryption_round_trip(spark):
    spark.conf.set(security.KEY_CONF, "MDEyMzQ1Njc4OWFiY2RlZjAxMjM0NTY3ODlhYmNkZWY=")
    key, iv = security.key_from_conf(spark), F.unhex(F.lit("00" * 16))
    df = spark.createDataFrame([("é" * 40,), ("é" * 40,), ("",)], "v string").select(
        "v", security.encrypt(F.col("v"), key, iv).alias("fixed"),
        security.encrypt(F.col("v"), key).alias("random"))
    rows = df.select("*", security.decrypt(F.col("fixed"), key, iv).alias("a"),
                     security.decrypt(F.col("random"), key).alias("b")).collect()
    assert all(r.a == r.b == r.v and "\n" not in r.fixed for r in rows)
    assert rows[0].fixed == rows[1].fixed and rows[0].random != rows[1].random
    assert df.select(security.decrypt(F.lit("bm90IGNpcGhlcg=="), key, iv)).first()[0] is None


def test_jdbc_types_and_options(spark):
    assert jdbc.spark_type("NUMERIC", 60, -1) == "decimal(38,0)"
    assert jdbc.spark_type("real") == "double"
    assert jdbc.spark_type("TINYINT") == "int"
    assert jdbc.spark_type("SQLXML") == "string"
    assert jdbc.options("u", "select 1")["query"] == "select 1"
    split = jdbc.options("u", "select 1", partition_column="id", lower=0, upper=9, partitions=3)
    assert split["dbtable"] == "(select 1) remote_query" and "query" not in split
    with pytest.raises(ValueError, match="partitioned read"):
        jdbc.options("u", "select 1", partition_column="id")
    typed = jdbc.typed(spark.range(1).selectExpr("cast(id AS tinyint) AS a", "1.50bd AS b"), {"a": "int", "b": "double"})
    assert [f.dataType.simpleString() for f in typed.schema] == ["int", "double"]


def test_jdbc_types_of_a_result(spark):
    df = spark.range(1).selectExpr("cast(id AS tinyint) AS a", "cast(id AS float) AS b", "1.50bd AS c", "'x' AS d",
                                   "timestamp_ntz'2024-01-01' AS e")
    assert jdbc.result_types(df) == {"a": "int", "b": "double", "e": "timestamp"}
    assert [f.dataType.simpleString() for f in jdbc.typed(df, jdbc.result_types(df)).schema] == [
        "int", "double", "decimal(3,2)", "string", "timestamp"]


def test_key_value(spark):
    pairs = spark.createDataFrame([("a", "ip", "h"), ("a", "port", "5"), ("b", "port", "x")],
                                  "entity string, key string, value string")
    got = {r.entity: (r.ip, r.port) for r in wide_rows(pairs, {"ip": "string", "port": "int"}).collect()}
    assert got == {"a": ("h", 5), "b": (None, None)}
