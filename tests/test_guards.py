"""Guards against a brute-force comparison of every candidate with every log row."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import guards

BASE = datetime(2024, 1, 10, 20)
LOG = ("job_nm string, tasksgroup_nm string, dag_run_id string, round_time timestamp_ntz, "
       "job_start_time timestamp_ntz, ictrl_dt string, status string, err_msg string")
CANDIDATE = ("job_nm string, tasksgroup_nm string, round_time timestamp_ntz, dag_run_id string, "
             "ictrl_dt string, labels array<string>, now timestamp_ntz")


def make(seed: int, size: int):
    rng = random.Random(seed)

    def moment(minutes: int = 480) -> datetime:
        return BASE + timedelta(minutes=rng.randrange(0, minutes, 20))

    def maybe(value):
        return None if rng.random() < 0.1 else value

    logs = [
        (rng.choice("AB"), "G", maybe(rng.choice("rstuv")), maybe(moment()), maybe(moment()),
         rng.choice(["1", "2", None]), rng.choice(["RUNNING", "RUNNING", "SUCCEED", "FAILED"]),
         rng.choice(["-", "late"]))
        for _ in range(size)
    ]
    seen, candidates = set(), []
    for _ in range(60):
        row = (rng.choice("AB"), "G", moment(), rng.choice("rstuvw"), rng.choice("12"),
               rng.choice([["1"], ["2"], ["1", "2"]]), moment())
        if row[:4] not in seen:
            seen.add(row[:4])
            candidates.append(row)
    return logs, candidates


def keys(df) -> set:
    return {(r.job_nm, r.round_time, r.dag_run_id) for r in df.collect()}


@pytest.mark.parametrize(("seed", "size"), [(1, 12), (2, 40), (3, 200), (4, 15), (5, 60), (6, 25), (7, 100)])
def test_guards_match_brute_force(spark, seed, size):
    logs, candidates = make(seed, size)
    log, cand = spark.createDataFrame(logs, LOG), spark.createDataFrame(candidates, CANDIDATE)
    running = [r for r in logs if r[6] == "RUNNING"]
    hours = timedelta(hours=3)
    transform, ingest, cdr, null, done = set(), {}, {}, set(), set()
    for job, _, rnd, run, label, wanted, now in candidates:
        key = (job, rnd, run)
        if any(r[0] == job and r[5] in wanted and None not in r[2:5] and r[2] != run and r[3] != rnd
               and r[4] >= now - hours for r in running):
            transform.add(key)
        for found, same in ((ingest, lambda r: r[5] == label), (cdr, lambda r: r[5] is not None)):
            others = [(r[3], r[2] or "") for r in running if r[0] == job and same(r) and r[3] not in (rnd, None)]
            if others and max(others)[0].date() == rnd.date():
                found[key] = (max(others)[0], max(others)[1] or None)
        if any(r[0] == job and r[5] is None and r[3] and rnd - hours <= r[3] < rnd for r in running):
            null.add(key)
        if any(r[0] == job and r[5] == label and r[6] == "SUCCEED" and r[7] == "-" for r in logs):
            done.add(key)
    assert keys(guards.blocked_transform(cand, log)) == transform
    for expected, any_label in ((ingest, False), (cdr, True)):
        rows = guards.blocked_ingest(cand, log, any_label).collect()
        assert {(r.job_nm, r.round_time, r.dag_run_id): (r.other_round, r.other_run) for r in rows} == expected
    assert keys(guards.blocked_null_label(cand, log)) == null
    assert keys(guards.already_succeeded(cand, log)) == done
    everyone = {(c[0], c[2], c[3]) for c in candidates}
    assert keys(guards.without_succeeded(cand, log)) == everyone - done


def test_an_attempt_without_a_round_hides_no_other(spark):
    """Three attempts of one run; the newest has no round, so the third decides for round 10."""
    at = lambda hour, minute=0: datetime(2024, 1, 10, hour, minute)
    logs = [("J", "G", "a", rnd, start, "L", "RUNNING", "-")
            for rnd, start in ((None, at(12)), (at(10), at(11, 59)), (at(11), at(11, 58)))]
    candidate = [("J", "G", at(10), "c", "L", ["L"], at(12, 30))]
    blocked = guards.blocked_transform(spark.createDataFrame(candidate, CANDIDATE), spark.createDataFrame(logs, LOG))
    assert blocked.count() == 1


def test_guards_read_the_log_they_need(spark, tmp_path):
    logs, candidates = make(2, 40)
    spark.createDataFrame(logs, LOG).write.parquet(str(tmp_path / "log"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    log, cand = spark.read.parquet(str(tmp_path / "log")), spark.createDataFrame(candidates, CANDIDATE)
    for blocked, column in (
        (guards.blocked_transform(cand, log), "job_start_time"), (guards.blocked_ingest(cand, log), "round_time"),
        (guards.blocked_ingest(cand, log, True), "round_time"), (guards.blocked_null_label(cand, log), "round_time"),
    ):
        plan = blocked._jdf.queryExecution().executedPlan().toString()
        pushed = next(x for x in plan.split("PushedFilters: ")[1:] if "status" in x.split("]")[0])
        assert f"GreaterThanOrEqual({column}," in pushed
    nobody = spark.createDataFrame([], CANDIDATE)
    assert guards.blocked_transform(nobody, log).count() == guards.blocked_ingest(nobody, log).count() == 0


def test_outcome_prefers_the_label_guard(spark):
    logs, candidates = make(3, 200)
    log, cand = spark.createDataFrame(logs, LOG), spark.createDataFrame(candidates, CANDIDATE)
    by_label, by_null = guards.blocked_ingest(cand, log), guards.blocked_null_label(cand, log)
    events = guards.outcome_events(by_label, by_null).collect()
    labelled = keys(by_label)
    assert {(r.job_nm, r.round_time, r.dag_run_id) for r in events} == labelled | keys(by_null)
    for r in events:
        assert (r.status, r.duration, r.row_cnt) == ("FAILED", "00:00:00", 0)
        assert ("with ictrl_dt NULL" in r.err_msg) == ((r.job_nm, r.round_time, r.dag_run_id) not in labelled)
