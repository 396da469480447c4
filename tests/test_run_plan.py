"""Whole runs: dates in order, one job at a time left to itself, against a loop that goes date by date."""

from __future__ import annotations

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import audit, backlog, loads
from tidemark.operators.validation import Rule
from tidemark.plans import run_plan

ROW = "k int, part string, v int, w int, load_ts string, ictrl_dt string"
NOW = datetime(2024, 1, 10)
LOG = ("log_kind string, job_nm string, tasksgroup_nm string, schema_nm string, table_nm string, dag_run_id string, "
       "round_time timestamp_ntz, job_start_time timestamp_ntz, ictrl_dt string, status string, row_cnt bigint, err_msg string")


def job(name, table, mode, watermark="20240106", pattern="%Y%m%d", kind="transform", partition=None, key="k", columns=None,
        condition=None, frequency="daily"):
    return (name, "g", kind, "Y", frequency, "0", None, "sequence", pattern, watermark, None, table, mode, partition, key,
            condition, columns, "N", "batch")


def jobs_of(spark, rows, now=NOW):
    return spark.createDataFrame(rows, schemas.JOBS).withColumn("start_time", F.lit(now).cast("timestamp_ntz"))


def dep(name, on):
    return (f"d_{name}", name, "Y", on, "s", "t", "daily", None, 0, None, "%Y%m%d")


def logged(name, label, status="SUCCEED", kind="trans", start=datetime(2024, 1, 1), run="r", group="g"):
    return (kind, name, group, "s", "t", run, start, start, label, status, 1, "-")


def run(spark, jobs, staged, deps=(), log=(), rules=(), **more):
    return run_plan.execute(
        jobs, spark.createDataFrame(list(deps), schemas.DEPENDENCIES), spark.createDataFrame(list(log), LOG), None,
        {n: spark.createDataFrame(r, ROW) for n, r in staged.items()}, rules, "today", **more)


@pytest.fixture
def table(spark):
    made = []

    def make(rows=(), partition_by=()):
        made.append(f"run_{uuid.uuid4().hex[:10]}")
        loads.create_table(spark.createDataFrame(list(rows), ROW), made[-1], partition_by)
        return made[-1]

    yield make
    for name in made:
        loads.drop_table(spark, name)


def content(spark, name):
    return sorted(map(tuple, spark.table(name).select("k", "part", "v", "w", "load_ts", "ictrl_dt").collect()), key=repr)


def state_of(done):
    return {(r["job_nm"], r["ictrl_dt"]): (r["status"], r["err_msg"]) for r in done.state.collect()}


def watermarks(done):
    return {r["job_nm"]: r["last_success_ictrl_dt"] for r in done.jobs.collect()}


def test_watermark_follows_time_not_text(spark, table):
    name = table()
    staged = {"j": [(1, "a", 1, 1, "x", d) for d in ("31/01/1998", "01/02/1998", "02/02/1998")]}
    jobs = jobs_of(spark, [job("j", name, "append", "30/01/1998", "%d/%m/%Y")], datetime(1998, 2, 2))
    done = run(spark, jobs, staged)
    assert watermarks(done) == {"j": "02/02/1998"} and len(content(spark, name)) == 3
    assert {s for s, _ in state_of(done).values()} == {"SUCCESS"}


def test_a_run_ends_at_the_first_date_that_waits(spark, table):
    name = table()
    staged = {"j": [(1, "a", 1, 1, "x", f"202401{d:02}") for d in (7, 8, 9, 10)]}
    log = [logged("up", f"202401{d:02}") for d in (7, 9, 10)]
    done = run(spark, jobs_of(spark, [job("j", name, "append")]), staged, [dep("j", "up")], log)
    assert [r[5] for r in content(spark, name)] == ["20240107"] and watermarks(done) == {"j": "20240107"}
    assert state_of(done) == {
        ("j", "20240107"): ("SUCCESS", "-"),
        ("j", "20240108"): ("FAILED", "The dependency job check failed because this job = up is not finished"),
    }
    # the next run goes on where this one ended, with what was folded before
    log.append(logged("up", "20240108"))
    again = run(spark, done.jobs, staged, [dep("j", "up")], log, snapshot=done.snapshot)
    assert watermarks(again) == {"j": "20240110"} and len(content(spark, name)) == 4
    assert again.events.count() == 6 and {s for s, _ in state_of(again).values()} == {"SUCCESS"}


def test_several_dates_load_as_one_after_another(spark, table):
    old = [(1, "a", 0, 0, "old", "20240101")]
    up, cols, full, parts, upd = table(old), table(old), table(old), table(old, ["part"]), table(old)
    rows = [(1, "b", 7, 70, "n7", "20240107"), (2, "b", 7, 70, "n7", "20240107"), (1, "c", 9, 90, "n9", "20240109"),
            (2, "a", 10, 100, "n10", "20240110"), (None, "a", 8, 80, "n8", "20240108"), (None, "a", 9, 80, "n9", "20240109")]
    jobs = [job("up", up, "upsert"), job("cols", cols, "UPSERT", columns="['v', 'load_ts']"), job("full", full, "full_load"),
            job("parts", parts, "overwrite", partition="['part']"), job("upd", upd, "update", columns="['w', 'load_ts']")]
    done = run(spark, jobs_of(spark, jobs), {j[0]: rows for j in jobs})
    assert set(watermarks(done).values()) == {"20240110"}
    free = [(None, "a", 8, 80, "n8", "20240108"), (None, "a", 9, 80, "n9", "20240109")]
    assert content(spark, up) == sorted([(1, "c", 9, 90, "old", "20240109"), (2, "a", 10, 100, "n7", "20240110"), *free], key=repr)
    assert content(spark, cols) == sorted([(1, "a", 9, 0, "old", "20240101"), (2, "b", 10, 70, "n7", "20240107"), *free], key=repr)
    assert content(spark, full) == [(2, "a", 10, 100, "n10", "20240110")]
    assert content(spark, parts) == sorted([rows[3], rows[0], rows[1], rows[2]], key=repr)
    assert content(spark, upd) == [(1, "a", 0, 90, "n9", "20240101")]


def test_a_failing_date_leaves_those_before_it(spark, table):
    name, other = table([(1, "a", 0, 0, "old", "20240101")]), table()
    staged = {"j": [(1, "b", 7, 7, "n", "20240107"), (1, "c", 8, 8, "n", "20240108"), (1, "d", 8, 8, "n", "20240108"),
                    (1, "e", 9, 9, "n", "20240109")], "fine": [(1, "a", 1, 1, "x", "20240107")]}
    done = run(spark, jobs_of(spark, [job("j", name, "upsert"), job("fine", other, "append"), job("lost", other, "append")]), staged)
    assert content(spark, name) == [(1, "b", 7, 7, "old", "20240107")] and len(content(spark, other)) == 1
    state = state_of(done)
    assert watermarks(done) == {"j": "20240107", "fine": "20240110", "lost": "20240106"}
    assert state[("j", "20240107")][0] == "SUCCESS" and state[("j", "20240108")][1].startswith("DuplicateSourceError")
    assert ("j", "20240109") not in state
    # a job without staging fails alone, on its first date
    assert state[("lost", "20240107")] == ("FAILED", "KeyError: 'lost'") and ("lost", "20240108") not in state


def test_an_error_without_text(spark, table, monkeypatch):
    name = table()

    def broken(*_, **__):
        raise RuntimeError

    monkeypatch.setattr(loads, "load", broken)
    done = run(spark, jobs_of(spark, [job("j", name, "append")]), {"j": [(1, "a", 1, 1, "x", "20240107")]})
    assert state_of(done) == {("j", "20240107"): ("FAILED", "RuntimeError: ")} and watermarks(done) == {"j": "20240106"}


def test_rules_hold_for_the_table_as_each_date_leaves_it(spark, table):
    name = table()
    staged = {"j": [(d, "a", d, 1, "x", f"202401{d:02}") for d in (7, 8, 9, 10)]}
    rules = [Rule("top", name, "max(v)", ("v",), 8.0, "<=")]
    done = run(spark, jobs_of(spark, [job("j", name, "append")]), staged, rules=rules)
    assert watermarks(done) == {"j": "20240108"} and len(content(spark, name)) == 3
    assert state_of(done)[("j", "20240109")] == ("FAILED", "validation failed: top") and ("j", "20240110") not in state_of(done)


def test_blocked_runs_leave_an_event_and_end_their_job(spark, table):
    a, b = table(), table()
    staged = {n: [(1, "a", 1, 1, "x", f"202401{d:02}") for d in (7, 8, 9, 10)] for n in ("tr", "ing")}
    recent = NOW - timedelta(hours=1)
    log = [logged("tr", "20240109", "RUNNING", start=recent), logged("ing", "20240108", "RUNNING", "ingest", NOW + timedelta(hours=1))]
    done = run(spark, jobs_of(spark, [job("tr", a, "append"), job("ing", b, "append", kind="file")]), staged, log=log)
    state = state_of(done)
    assert watermarks(done) == {"tr": "20240108", "ing": "20240107"}
    assert state[("tr", "20240109")] == ("FAILED", "DropDuplicatesJobError: tr") and ("tr", "20240110") not in state
    assert state[("ing", "20240108")][1].startswith("DropDuplicatesJobError: Found Status RUNNING Job on ictrl_dt: 20240108")
    row = done.state.filter("job_nm = 'tr' AND ictrl_dt = '20240109'").first()
    assert row["row_cnt"] == 0


def test_dates_done_before_are_passed_over(spark, table):
    name = table()
    staged = {"j": [(1, "a", 1, 1, "x", f"202401{d:02}") for d in (7, 8, 9, 10)]}
    log = [logged("up", "20240107"), logged("up", "20240109"), logged("j", "20240108"), logged("j", "20240110")]
    done = run(spark, jobs_of(spark, [job("j", name, "append")]), staged, [dep("j", "up")], log)
    assert [r[5] for r in content(spark, name)] == ["20240107", "20240109"] and watermarks(done) == {"j": "20240110"}


def test_a_daily_run_counts_while_it_stages(spark, table):
    """One date: the row count is the staging write's own; the staged rows are read once, by the load."""
    name = table()
    staged = {"j": [(i, "a", 1, 1, "x", "20240110") for i in range(7)] + [(9, "a", 1, 1, "x", "20240111")]}
    done = run(spark, jobs_of(spark, [job("j", name, "append", "20240109")]), staged)
    assert [(r["row_cnt"], r["status"]) for r in done.state.collect()] == [(7, "SUCCESS")] and len(content(spark, name)) == 7


def test_nothing_due(spark, table):
    done = run(spark, jobs_of(spark, [job("j", table(), "append", "20240110")]), {})
    assert watermarks(done) == {"j": "20240110"} and done.events.count() == 0 and done.state.count() == 0


# --- date by date, in plain Python ---------------------------------------------------------


class Refused(Exception):
    pass


def load_one(target, rows, mode, part, columns, condition):
    """The target after one date. Rows are (k, part, v, w, load_ts, ictrl_dt)."""
    fields = ["k", "part", "v", "w", "load_ts", "ictrl_dt"]
    if mode == "full_load":
        return list(rows)
    if mode == "overwrite":
        return [t for t in target if t[1] not in {r[1] for r in rows}] + rows if part else list(rows)
    if mode == "append":
        return target + rows
    holds = (lambda s, t: s[2] > t[2]) if condition else (lambda s, t: True)
    out = []
    for t in target:
        found = [r for r in rows if r[0] is not None and r[0] == t[0] and (mode == "update" or holds(r, t))]
        if len(found) > 1:
            raise Refused
        if found and (mode == "upsert" or holds(found[0], t)):
            chosen = [c for c in (columns or fields) if not (mode == "upsert" and c == "load_ts")]
            t = tuple(found[0][i] if f in chosen else t[i] for i, f in enumerate(fields))
        out.append(t)
    if mode == "upsert":
        out += [r for r in rows if not any(r[0] is not None and r[0] == t[0] and holds(r, t) for t in target)]
    return out


def brute(jobs, staged, ready, done_before, tables, limits):
    state, marks = {}, {}
    for name, _, _, _, _, _, _, _, _, mark, _, table, mode, part, _, condition, columns, _, _ in jobs:
        target = list(tables[name])
        for day in range(7, 11):
            label = f"202401{day:02}"
            if (name, label) in done_before:
                mark = label
                continue
            if not ready[(name, label)]:
                state[(name, label)] = "waits"
                break
            try:
                rows = [r for r in staged[name] if r[5] == label]
                target = load_one(target, rows, mode, part, run_plan.names(columns), condition)
                if name in limits and not (target and max(t[2] for t in target) <= limits[name]):
                    raise Refused
            except Refused:
                state[(name, label)] = "fails"
                break
            state[(name, label)], mark = "SUCCESS", label
        tables[name], marks[name] = target, mark
    return state, marks, tables


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_date_by_date(spark, table, seed):
    rng = random.Random(seed)

    def rows(n, labels):
        return [(rng.choice([None, *range(6)]), rng.choice("abc"), rng.randint(0, 30), rng.randint(0, 9), f"t{rng.randint(0, 9)}",
                 rng.choice(labels)) for _ in range(n)]

    due = [f"202401{d:02}" for d in range(7, 11)]
    modes = [("full_load", None, None, None), ("overwrite", "part", None, None), ("overwrite", None, None, None), ("append", None, None, None),
             ("upsert", None, None, None), ("upsert", "part", None, None), ("upsert", None, "['v']", None), ("upsert", None, "['w', 'load_ts']", None),
             ("upsert", None, None, "src.v > trg.v"), ("update", None, "['v', 'load_ts']", None), ("update", None, "['w']", "src.v > trg.v")]
    jobs, staged, tables, names, limits = [], {}, {}, {}, {}
    for i, (mode, part, columns, condition) in enumerate(modes):
        name = f"j{i}"
        tables[name] = [r for r in rows(4, ["20240101"])]
        if mode in ("upsert", "update"):
            tables[name] = list({r[0]: r for r in tables[name]}.values())
        names[name] = table(tables[name], run_plan.names(part))
        # few rows: mostly no key twice on a date
        staged[name] = rows(rng.choice([0, 4, 7]), due)
        if rng.random() < 0.6:
            staged[name] = list({(r[0], r[5]): r for r in staged[name]}.values())
        jobs.append(job(name, names[name], mode, partition=part, columns=columns, condition=condition))
        if rng.random() < 0.2:
            limits[name] = rng.randint(15, 29)
    ready = {(j[0], d): rng.random() < 0.9 for j in jobs for d in due}
    done_before = {(j[0], d) for j in jobs for d in due if rng.random() < 0.08}
    log = [logged(f"up_{n}", d) for (n, d), ok in ready.items() if ok] + [logged(n, d) for n, d in done_before]
    rules = [Rule("top", names[n], "max(v)", ("v",), float(limit), "<=") for n, limit in limits.items()]
    done = run(spark, jobs_of(spark, jobs), staged, [dep(j[0], f"up_{j[0]}") for j in jobs], log, rules)
    state, marks, expected = brute(jobs, staged, ready, done_before, tables, limits)
    assert watermarks(done) == marks
    got = {k: "SUCCESS" if s == "SUCCESS" else "waits" if "is not finished" in e else "fails" for k, (s, e) in state_of(done).items()}
    assert got == state
    for name, target in expected.items():
        assert content(spark, names[name]) == sorted(target, key=repr), (name, modes[int(name[1:])])


def test_what_cannot_be_folded(spark):
    staged = spark.createDataFrame([(1, "a", 1, 1, "x", "d", NOW), (1, "b", 2, 1, "x", "d", NOW)], ROW + ", run_ts timestamp_ntz")
    assert backlog.fold(staged, "run_ts", NOW, "upsert", keys=["k"]) is None
    assert backlog.fold(staged.limit(1), "run_ts", NOW, "upsert", keys=["k"], condition="src.v > trg.v") is None
    assert backlog.fold(staged, "run_ts", NOW, "merge", keys=["k"]) is None


# --- incremental state -------------------------------------------------------------------------


def test_snapshots_add_up_in_any_split(spark):
    rng = random.Random(4)
    schema = ("log_kind string, job_nm string, tasksgroup_nm string, round_time timestamp_ntz, dag_run_id string, status string, "
              "row_cnt bigint, err_msg string, duration string, deleted boolean, event_time timestamp_ntz")
    events = [(
        rng.choice(["trans", "ingest"]), rng.choice("ab"), rng.choice([None, "g"]), NOW, rng.choice("12"),
        rng.choice(["RUNNING", "SUCCESS", "FAILED", None]), rng.choice([None, 1, 2]), rng.choice([None, "-", "x"]),
        rng.choice([None, "00:00:00"]), rng.choice([None, None, None, True]), NOW + timedelta(hours=rng.randint(0, 5)),
    ) for _ in range(120)]
    columns = ["status", "row_cnt", "err_msg"]
    whole = sorted(map(tuple, audit.fold(spark.createDataFrame(events, schema), columns).collect()), key=repr)
    for cuts in ([0], [60], [119], [5, 20, 100]):
        rng.shuffle(events)
        parts = [events[a:b] for a, b in zip([0, *cuts], [*cuts, len(events)])]
        state = audit.snapshot(spark.createDataFrame(parts[0], schema), columns)
        for part in parts[1:]:
            state = audit.combine(state, audit.snapshot(spark.createDataFrame(part, schema), columns))
        assert sorted(map(tuple, audit.current(state).collect()), key=repr) == whole


def test_adding_to_a_snapshot_does_not_shuffle_it(spark, tmp_path):
    schema = "log_kind string, job_nm string, tasksgroup_nm string, round_time timestamp_ntz, dag_run_id string, status string, event_time timestamp_ntz"
    one = spark.createDataFrame([("trans", "j", None, NOW, "1", "SUCCESS", NOW)], schema)
    audit.snapshot(one, ["status"]).write.parquet(str(tmp_path / "old"))
    old = spark.read.parquet(str(tmp_path / "old"))
    audit.snapshot(one, ["status"]).write.parquet(str(tmp_path / "new"))
    plan = audit.combine(old, spark.read.parquet(str(tmp_path / "new")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
