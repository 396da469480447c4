"""Frequency arithmetic, labels and catch-up against literal rows and a Python model."""

from __future__ import annotations

import calendar
import random
from datetime import datetime, timedelta

import pytest

from tidemark.functions import frequency as freq
from tidemark.functions import labels
from tidemark.operators import planning


def sql_value(spark, text: str):
    return spark.sql(f"SELECT {text} AS v").first().v


def ts(text: str) -> str:
    return f"TIMESTAMP_NTZ '{text}'"


def add_months(d: datetime, n: int) -> datetime:
    month = d.year * 12 + d.month - 1 + n
    year, month = divmod(month, 12)
    return d.replace(year=year, month=month + 1,
                     day=min(d.day, calendar.monthrange(year, month + 1)[1]))


MODEL = {
    "15m": lambda d, n: d + timedelta(minutes=15 * n),
    "2h": lambda d, n: d + timedelta(hours=2 * n),
    "hourly": lambda d, n: d + timedelta(hours=n),
    "": lambda d, n: d + timedelta(days=n),
    "Daily": lambda d, n: d + timedelta(days=n),
    "weekly": lambda d, n: d + timedelta(days=7 * n),
    "monthly": add_months,
    "quarterly": lambda d, n: add_months(d, 3 * n),
    "yearly": lambda d, n: add_months(d, 12 * n),
}


def test_steps_match_python_model(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        name = rng.choice(list(MODEL))
        start = datetime(2023, 1, 1) + timedelta(minutes=rng.randrange(900 * 1440))
        rows.append((i, start, name, str(rng.randrange(-3, 15))))
    df = spark.createDataFrame(rows, "i int, ts timestamp_ntz, f string, n string").selectExpr(
        "i", f"{freq.plus_steps('ts', 'f', 'n')} AS plus", f"{freq.minus_steps('ts', 'f', 'n')} AS minus"
    )
    got = {r.i: (r.plus, r.minus) for r in df.collect()}
    for i, start, name, n in rows:
        assert got[i] == (MODEL[name](start, int(n)), MODEL[name](start, -int(n))), (start, name, n)


@pytest.mark.parametrize(("expression", "expected"), [
    (freq.minus_steps(ts("2024-03-31"), "'monthly'", "1"), datetime(2024, 2, 29)),
    (freq.minus_steps(ts("2024-02-29"), "'yearly'", "'1'"), datetime(2023, 2, 28)),
    (freq.minus_steps(ts("2024-01-05"), "null", "null"), datetime(2024, 1, 5)),
    (freq.minus_steps(ts("2024-01-05"), "'sometimes'", "1"), None),
    (freq.minus_steps(ts("2024-01-05"), "'daily'", "'x'"), None),
    (freq.overlap_start(ts("2024-01-05"), "'daily'", "''"), datetime(2024, 1, 5)),
    (freq.overlap_start(ts("2024-01-05"), "'2h'", "'3'"), datetime(2024, 1, 4, 18)),
    (freq.overlap_start(ts("2024-01-05"), "'daily'", "'-1'"), None),
    (labels.parse("'20240131'", "'%Y%m%d'"), datetime(2024, 1, 31)),
    (labels.parse("'2024013109'", "'%Y%m%d%H'"), datetime(2024, 1, 31, 9)),
    (labels.parse("'20240231'", "'%Y%m%d'"), None),
    (labels.parse("'202401'", "'%Y%m'"), None),
    (labels.render(ts("2024-01-31 09:08:07.123456"), "'%d/%m/%Y %H:%M:%S.%f%%'"),
     "31/01/2024 09:08:07.123456%"),
    (labels.render(ts("2024-01-31"), "'%Y-W%U'"), None),
    (labels.render(ts("2024-01-31 15:00:00"), "'%y %b %I %p'"), "24 Jan 03 PM"),
    (labels.sorts_chronologically("'%Y%m%d'"), True),
    (labels.sorts_chronologically("'%d%m%Y'"), False),
    (labels.sorts_chronologically("'%Y%m%d %I'"), False),
    (labels.sorts_chronologically("'%%%Y%m'"), True),
    (labels.is_supported("'yyyyMMdd'"), False),
    (labels.is_supported("null"), False),
])
def test_literal_rows(spark, expression, expected):
    assert sql_value(spark, expression) == expected


def test_iterative_months_stay_clamped(spark):
    dates = sql_value(spark, freq.steps_between(
        ts("2024-01-31"), ts("2024-05-30"), "cast(null AS bigint)", "1"))
    assert [d.strftime("%m-%d") for d in dates] == ["01-31", "02-29", "03-29", "04-29", "05-29"]


def test_steps_between_is_empty_or_null(spark):
    assert sql_value(spark, freq.steps_between(ts("2024-02-01"), ts("2024-01-01"), "1440L", "null")) == []
    assert sql_value(spark, freq.steps_between(ts("2024-01-01"), ts("2024-02-01"), "0L", "null")) is None


JOB = ("job_nm string, job_type string, frequency string, back_day string, overlap string, "
       "catchup_type string, ictrl_dt_tgtfmt string, cdr_flag string, "
       "last_success_ictrl_dt string, fixed_date string, start_time timestamp_ntz")


def test_planned_runs(spark):
    now = datetime(2024, 3, 10, 12)
    jobs = spark.createDataFrame([
        ("seq", "transform", "daily", "1", None, "sequence", None, None, "20240306", None, now),
        ("period", "transform", "daily", "1", "2", "period", None, None, "20240306", None, now),
        ("ahead", "transform", "daily", "1", None, "sequence", None, None, "20240320", None, now),
        ("ingest", "ingestDb", "daily", "0", "1", "period", "%Y%m%d", None, "20240308", None, now),
        ("cdr", "file", "daily", "0", None, None, "%Y%m%d", "Y", "20200101", None, now),
        ("fixed", "transform", "daily", "5", None, "period", "%Y%m%d", None, None, "20230102", now),
        ("odd", "transform", "often", "5", None, "period", "%Y%m%d", None, None, None, now),
        ("bad_mark", "transform", "daily", "0", None, "period", "%Y%m%d", None, "soon", None, now),
    ], JOB)
    runs = planning.planned_runs(jobs)
    got = {}
    for r in runs.orderBy("run_ts").collect():
        got.setdefault(r.job_nm, []).append((r.ictrl_dt, r.start_ictrl_dt, r.end_ictrl_dt, r.start_with_overlap))
    assert [g[0] for g in got["seq"]] == ["20240307", "20240308", "20240309"]
    assert got["period"] == [("20240309", "20240304", "20240309", "20240304")]
    assert got["ingest"] == [  # one step after the watermark, at midnight, up to noon of the day
        ("20240309", "20240309", "20240310", "20240308"),
        ("20240310", "20240309", "20240310", "20240309"),
    ]
    assert got["cdr"] == [("20240310", "20240310", "20240310", "20240310")]
    assert got["fixed"] == [("20230102",) * 4]
    assert not {"ahead", "odd", "bad_mark"} & set(got)
    problems = {r.job_nm: r.problem for r in planning.plan_dates(jobs).collect()}
    assert problems["odd"] == "invalid_frequency"
    assert problems["bad_mark"] == "invalid_watermark"


def test_delay_schedule(spark):
    requests = spark.createDataFrame(
        [("w", datetime(2024, 1, 10).date()), ("m", datetime(2024, 1, 10).date()),
         ("late", datetime(2024, 1, 10).date()), ("none", datetime(2024, 1, 10).date()),
         ("off", datetime(2024, 1, 10).date()), ("feb", datetime(2024, 2, 10).date())],
        "job_nm string, ref_date date")
    delays = spark.createDataFrame([
        ("w", "ingestion", "Tuesday", "2", "week", "Y"), ("m", "ingestion", "5", "2", "month", "Y"),
        ("late", "ingestion", "25", "1", "month", "Y"), ("off", "ingestion", "5", "2", "month", None),
        ("feb", "ingestion", "31", "2", "month", "Y"),
    ], "job_nm string, job_type string, date_start_job string, total_delay string, mode string, flag string")
    got = {r.job_nm: (r.delay_days, r.last_day)
           for r in planning.delay_schedule(requests, delays).collect()}
    assert got["w"] == (["2024-01-09", "2024-01-10"], "2024-01-10")
    assert got["m"] == (["2024-01-05", "2024-01-06"], "2024-01-06")
    assert got["late"] == (["2023-12-25"], "2023-12-25")
    assert got["none"] == got["off"] == got["feb"] == ([], "-")
