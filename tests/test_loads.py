"""Load modes on literal rows."""

from __future__ import annotations

import math
import uuid
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import loads
from tidemark.sources import staging
from tidemark.streaming import micro_batch

SCHEMA = "k int, part string, v int, load_ts string"


@pytest.fixture
def table(spark):
    def make(rows, partition_by=()):
        name = f"t_{uuid.uuid4().hex[:10]}"
        loads.create_table(spark.createDataFrame(rows, SCHEMA), name, partition_by)
        return name

    return make


def rows(spark, name):
    return sorted(map(tuple, spark.table(name).select("k", "part", "v", "load_ts").collect()), key=str)


OLD = [(1, "a", 10, "old"), (2, "a", 20, "old"), (None, "b", 30, "old")]


def test_upsert(spark, table):
    name = table(OLD)
    staged = spark.createDataFrame([(2, "b", 21, "new"), (3, "c", 31, "new"), (None, "b", 9, "new")], SCHEMA)
    loads.load(staged, name, "UPSERT", keys=["k"])
    assert rows(spark, name) == sorted([
        (1, "a", 10, "old"), (2, "b", 21, "old"), (None, "b", 30, "old"),
        (3, "c", 31, "new"), (None, "b", 9, "new"),  # a null key never matches
    ], key=str)
    loads.load(staged.filter("k IS NOT NULL"), name, "upsert", keys=["k"])  # twice is once
    assert spark.table(name).count() == 5


def test_upsert_condition_that_fails_inserts(spark, table):
    name = table(OLD)
    staged = spark.createDataFrame([(1, "a", 5, "new"), (2, "a", 50, "new")], SCHEMA)
    loads.upsert(staged, name, ["k"], condition="src.v > trg.v")
    assert rows(spark, name) == sorted([
        (1, "a", 10, "old"), (1, "a", 5, "new"), (2, "a", 50, "old"), (None, "b", 30, "old")], key=str)


def test_upsert_without_columns_only_inserts(spark, table):
    name = table(OLD)
    staged = spark.createDataFrame([(1, "a", 5, "new"), (4, "a", 50, "new")], SCHEMA)
    loads.upsert(staged, name, ["k"], update_columns=[])
    assert rows(spark, name) == sorted([*OLD, (4, "a", 50, "new")], key=str)


@pytest.mark.parametrize("condition", [None, "src.v > 0"])
def test_duplicate_source_is_refused(spark, table, condition):
    name = table(OLD)
    staged = spark.createDataFrame([(1, "a", 5, "x"), (1, "a", 6, "x"), (9, "a", 1, "x"), (9, "a", 2, "x")], SCHEMA)
    with pytest.raises(loads.DuplicateSourceError):
        loads.upsert(staged, name, ["k"], condition)
    assert rows(spark, name) == sorted(OLD, key=str)
    loads.upsert(staged.filter("k = 9"), name, ["k"])  # no target row: both are inserted
    assert spark.table(name).filter("k = 9").count() == 2


def test_one_source_row_meeting_the_condition_is_fine(spark, table):
    name = table(OLD)
    staged = spark.createDataFrame([(1, "a", 5, "x"), (1, "a", 60, "x")], SCHEMA)
    loads.upsert(staged, name, ["k"], condition="src.v > trg.v")
    assert sorted(r.v for r in spark.table(name).filter("k = 1").collect()) == [5, 60]


def test_update(spark, table):
    name = table(OLD)
    staged = spark.createDataFrame([(1, "z", 11, "new"), (2, "z", 21, "new"), (7, "z", 7, "new")], SCHEMA)
    loads.load(staged, name, "update", keys=["k"], update_columns=["v"], condition="trg.v < 20")
    assert rows(spark, name) == sorted(
        [(1, "a", 11, "old"), (2, "a", 20, "old"), (None, "b", 30, "old")], key=str)
    with pytest.raises(ValueError, match="at least one column"):
        loads.load(staged, name, "update", keys=["k"])


def test_upsert_moves_rows_between_partitions(spark, table):
    name = table([(1, "a", 10, "old"), (2, "b", 20, "old"), (3, "c", 30, "old")], ["part"])
    staged = spark.createDataFrame([(1, "b", 11, "new"), (4, "d", 40, "new")], SCHEMA)
    loads.upsert(staged, name, ["k"])
    assert rows(spark, name) == [
        (1, "b", 11, "old"), (2, "b", 20, "old"), (3, "c", 30, "old"), (4, "d", 40, "new")]
    # the emptied partition holds nothing that a later append could bring back
    loads.append(spark.createDataFrame([(5, "a", 50, "new")], SCHEMA), name)
    assert spark.table(name).filter("part = 'a'").count() == 1


def test_partition_overwrite_goes_by_name(spark, table):
    name = table([(1, "a", 10, "old"), (2, "b", 20, "old")], ["part"])
    staged = spark.createDataFrame([("b", "new", 9, 99), (None, "new", 8, 88)],
                                   "part string, load_ts string, k int, v int")
    loads.load(staged, name, "overwrite", partition_by=["part"])
    assert rows(spark, name) == sorted(
        [(1, "a", 10, "old"), (9, "b", 99, "new"), (8, None, 88, "new")], key=str)


def test_full_load_replaces_schema(spark, table):
    name = table(OLD)
    loads.load(spark.createDataFrame([(1, 2)], "x int, y int"), name, "full_load", partition_by=["part"])
    assert spark.table(name).columns == ["x", "y"]


def test_unknown_mode(spark, table):
    with pytest.raises(ValueError, match="unsupported load mode"):
        loads.load(spark.range(1), table(OLD), "merge")


def test_feed_partitions(spark):
    name = f"feed_{uuid.uuid4().hex[:10]}"
    schema = "v int, feed_ind string, ictrl_dt string"
    loads.overwrite_feed_partitions(spark.createDataFrame([(1, "F", "1"), (2, "G", "1")], schema), name)
    loads.overwrite_feed_partitions(spark.createDataFrame([(3, "F", "1"), (4, "F", "2")], schema), name)
    assert sorted(r.v for r in spark.table(name).collect()) == [2, 3, 4]


def test_staging_prefers_the_job(spark):
    job, target = f"j_{uuid.uuid4().hex[:8]}", f"t_{uuid.uuid4().hex[:8]}"
    loads.create_table(spark.range(1), f"{target}_tmp_validation")
    assert staging.staged_table(spark, job, target).count() == 1
    loads.create_table(spark.range(2), f"{job}_tmp_validation")
    assert staging.staged_table(spark, job, target).count() == 2
    assert staging.staged_table(spark, "", target).count() == 1


def test_replayed_batch_loads_once(spark, table, tmp_path):
    name = table(OLD)
    log = micro_batch.BatchLog(spark, str(tmp_path / "batches"))
    batch = spark.createDataFrame([(1, "a", 15, "new"), (1, "a", 16, "newer")], SCHEMA)
    args = (log, name, "upsert")
    assert micro_batch.load_batch(batch, 0, *args, keys=["k"], order_by="v")
    assert not micro_batch.load_batch(batch.withColumn("v", batch.v + 100), 0, *args, keys=["k"], order_by="v")
    assert rows(spark, name) == sorted([(1, "a", 16, "old"), *OLD[1:]], key=str)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_an_older_batch_never_replaces_a_newer_row(spark, table, tmp_path, order):
    name = table(OLD)
    batches = [[(1, "a", 5, "x"), (7, "q", 1, "x")], [(1, "b", 50, "y"), (7, "q", 9, "y")], [(1, "c", 20, "z")]]
    log = micro_batch.BatchLog(spark, str(tmp_path / "batches"))
    for batch_id, i in enumerate(order):
        batch = spark.createDataFrame(batches[i], SCHEMA)
        assert micro_batch.load_batch(batch, batch_id, log, name, "upsert", keys=["k"], order_by="v")
    # an equal value leaves the row; a replay of an old batch is skipped
    same = spark.createDataFrame([(1, "other", 50, "w")], SCHEMA)
    assert micro_batch.load_batch(same, 3, log, name, "upsert", keys=["k"], order_by="v")
    assert not micro_batch.load_batch(spark.createDataFrame(batches[0], SCHEMA), 1, log, name, "upsert", keys=["k"], order_by="v")
    assert log.highest() == 3
    got = {r.k: (r.part, r.v) for r in spark.table(name).filter("k IS NOT NULL").collect()}
    assert got == {1: ("b", 50), 2: ("a", 20), 7: ("q", 9)}


def test_newer_file_first(spark, table, tmp_path):
    name, source = table([]), str(tmp_path / "in")
    for v, when in ((9, "newer"), (3, "older")):
        spark.createDataFrame([(1, "a", v, when)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = micro_batch.file_stream(spark, source, SCHEMA)
        micro_batch.start(stream, name, "upsert", str(tmp_path / "state"), available_now=True,
                          keys=["k"], order_by="v").awaitTermination()
    spark.catalog.refreshTable(name)
    assert [r.v for r in spark.table(name).collect()] == [9]


def test_ties_and_nulls_of_the_order(spark):
    rows = [(1, "a", 5, "x"), (1, "b", 5, "y"), (2, "c", None, "z")]
    found = {tuple(sorted(map(tuple, micro_batch.newest_versions(spark.createDataFrame(r, SCHEMA), ["k"], "v").collect())))
             for r in (rows, rows[::-1])}
    assert len(found) == 1 and (2, "c", None, "z") in found.pop()


def test_an_unreadable_batch_log_is_an_error(spark, tmp_path):
    (tmp_path / "log" / "0").mkdir(parents=True)
    (tmp_path / "log" / "0" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        micro_batch.BatchLog(spark, str(tmp_path / "log")).has(0)


def test_stream_restarts_where_it_stopped(spark, tmp_path):
    name, source = f"s_{uuid.uuid4().hex[:8]}", str(tmp_path / "in")
    loads.create_table(spark.createDataFrame([], "id bigint, batch_id bigint"), name, ["batch_id"])
    for first in (0, 10):
        spark.range(first, first + 10, 1, 1).write.mode("append").parquet(source)
        stream = micro_batch.file_stream(spark, source, "id bigint")
        micro_batch.start(stream, name, "append", str(tmp_path / "state"), available_now=True).awaitTermination()
        spark.catalog.refreshTable(name)
        assert spark.table(name).count() == first + 10
    log = micro_batch.BatchLog(spark, str(tmp_path / "unlogged"))
    # dying between load and record repeats the batch into its own partition
    micro_batch.load_batch(spark.range(10, 20), 1, log, name, "append")
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 20


@pytest.mark.parametrize("mode", ["upsert", "update"])
def test_keys_and_columns_are_checked_before_anything_is_written(spark, table, mode):
    name = table(OLD)
    staged = spark.createDataFrame([(1, "a", 5, "new")], SCHEMA)
    for options, message in (
        ({"keys": []}, "by keys"), ({"keys": ["nope"]}, "no column nope"),
        ({"keys": ["k"], "update_columns": ["vv"]}, "no column vv"),
    ):
        with pytest.raises(ValueError, match=message):
            loads.load(staged, name, mode, **{"update_columns": ["v"], **options})
    with pytest.raises(ValueError, match="no column"):
        loads.load(staged.drop("v"), name, mode, keys=["k"], update_columns=["v"])
    assert rows(spark, name) == sorted(OLD, key=str)


@pytest.mark.parametrize("mode", ["upsert", "update"])
def test_wider_staged_types_are_brought_to_the_table(spark, table, mode):
    name = table(OLD)
    staged = spark.createDataFrame([(1, "a", 5, "new")], SCHEMA.replace("int", "bigint"))
    loads.load(staged, name, mode, keys=["k"], update_columns=["v"])
    assert (1, "a", 5, "old") in rows(spark, name)
    assert [f.dataType.simpleString() for f in spark.table(name).schema] == ["int", "string", "int", "string"]


# --- buckets --------------------------------------------------------------------------


@pytest.fixture
def bucketed(spark):
    def make(rows, buckets=8):
        name = f"b_{uuid.uuid4().hex[:10]}"
        loads.create_table(spark.createDataFrame(rows, SCHEMA), name, buckets=buckets, bucket_by=["k"])
        return name

    return make


def files_of(spark, name):
    return set(session.file_names(spark, loads.location(spark, name)))


MANY = [(i, "a", i, "old") for i in range(200)] + [(None, "n", 1, "old")]


def test_only_touched_buckets_are_rewritten(spark, bucketed):
    name = bucketed(MANY)
    before = files_of(spark, name)
    staged = spark.createDataFrame([(7, "b", 70, "new")], SCHEMA)
    loads.load(staged, name, "upsert", keys=["k"])
    after = files_of(spark, name)
    bucket = staged.select(loads.bucket_of(["k"], 8)).first()[0]
    assert len(before) == 8 and {loads._bucket_in_name(n) for n in before - after} == {bucket} == {loads._bucket_in_name(n) for n in after - before}
    assert rows(spark, name) == sorted([r if r[0] != 7 else (7, "b", 70, "old") for r in MANY], key=str)
    # what Spark makes of the files as buckets is right: each key is found in its own
    for k in (7, 8, 199):
        assert spark.table(name).filter(F.col("k") == k).count() == 1
    read = loads._of_buckets(spark, name, list(after)[:2]).select("k")
    read.collect()
    found, todo = [], [read._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().apply("numFiles").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert found == [2]


def test_a_bucketed_target_is_not_moved(spark, bucketed):
    name = bucketed(MANY)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = spark.createDataFrame([(i, "b", 5, "new") for i in range(50, 300)], SCHEMA)
        target = loads._of_buckets(spark, name, files_of(spark, name))
        plan = loads.merged(target, staged, ["k"])._jdf.queryExecution().executedPlan().toString()
        # every exchange lies above staged rows alone
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                depth = len(line) - len(line.lstrip(" :+-"))
                below = []
                for other in lines[i + 1 :]:
                    if len(other) - len(other.lstrip(" :+-")) <= depth:
                        break
                    below.append(other)
                assert not any(name in other for other in below)
        assert plan.count("SortMergeJoin") >= 2 and "Exchange hashpartitioning" in plan
        loads.load(staged, name, "upsert", keys=["k"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    expected = [r for r in MANY if r[0] is None or r[0] < 50] + [(i, "b", 5, "old" if i < 200 else "new") for i in range(50, 300)]
    assert rows(spark, name) == sorted(expected, key=str)


def test_bucketed_loads_equal_others(spark, bucketed, table):
    staged = spark.createDataFrame([(3, "b", 1, "new"), (500, "c", 2, "new"), (None, "d", 3, "new"), (9, "e", 900, "new")], SCHEMA)
    for mode, options in (("upsert", {"keys": ["k"]}), ("upsert", {"keys": ["k"], "condition": "src.v > trg.v"}),
                          ("upsert", {"keys": ["k", "part"]}), ("update", {"keys": ["k"], "update_columns": ["v"]}),
                          ("update", {"keys": ["part"], "update_columns": ["k"]}), ("append", {}), ("full_load", {})):
        names = bucketed(MANY), table(MANY)
        for name in names:
            loads.load(staged, name, mode, **options)
            loads.load(staged.filter("k = 9"), name, "upsert", keys=["k"])
        assert rows(spark, names[0]) == rows(spark, names[1]), (mode, options)
        assert loads._buckets(spark, names[0]) == (8, ["k"])


@pytest.mark.parametrize("step", ["_replaced", "move", "delete"])
def test_buckets_killed_half_way_are_applied_once(spark, bucketed, monkeypatch, step):
    name = bucketed(MANY)
    staged = spark.createDataFrame([(i, "b", -1, "new") for i in range(20)], SCHEMA)
    options = {"keys": ["k"], "condition": "src.v > trg.v", "version": "s#4"}
    with monkeypatch.context() as patch:
        real, calls = getattr(loads, step), []

        def dying(*given):
            calls.append(given)
            if len(calls) == 2:
                raise Killed
            return real(*given)

        patch.setattr(loads, step, dying)
        with pytest.raises(Killed):
            loads.upsert(staged, name, **options)
    loads.upsert(staged, name, **options)
    loads.upsert(staged, name, **options)
    assert rows(spark, name) == sorted(MANY + [(i, "b", -1, "new") for i in range(20)], key=str)


class Killed(BaseException):
    pass


@pytest.mark.parametrize("partition", [(), ("part",)])
@pytest.mark.parametrize("dies", ["prepare", "note", "apply", "applied", "record"])
def test_a_conditional_upsert_killed_anywhere_replays_once(spark, table, tmp_path, monkeypatch, partition, dies):
    name = table(OLD, partition)
    batch = spark.createDataFrame([(1, "a", 5, "new"), (2, "c", 50, "new"), (None, "b", 1, "new")], SCHEMA)
    log = micro_batch.BatchLog(spark, str(tmp_path / "batches"))
    args = (batch, 0, log, name, "upsert")
    options = {"keys": ["k"], "condition": "src.v > trg.v"}
    where = {"prepare": (loads, "_prepare"), "note": (loads, "prepared"), "apply": (loads, "_apply"), "applied": (loads, "applied"),
             "record": (micro_batch.BatchLog, "record")}[dies]
    with monkeypatch.context() as patch:
        real = getattr(*where)

        def dying(*given, **named):
            if dies in ("apply", "note"):  # half way: done, but its caller never knows; or not even begun
                real(*given, **named)
            raise Killed

        patch.setattr(*where, dying)
        with pytest.raises(Killed):
            micro_batch.load_batch(*args, **options)
    assert micro_batch.load_batch(*args, **options)
    assert not micro_batch.load_batch(*args, **options)
    # the row that fails the condition is inserted once, as is the row without a key
    expected = [(1, "a", 10, "old"), (1, "a", 5, "new"), (2, "c", 50, "old"), (None, "b", 30, "old"), (None, "b", 1, "new")]
    assert rows(spark, name) == sorted(expected, key=str)
    assert loads.pending(spark, name) is None


def test_append_partitions_stay_few(spark, tmp_path):
    for fanout in (2, 3, 16):  # by the plan alone
        held = set()
        for batch in range(1000):
            held.add(batch)
            for first, last in micro_batch.merges(batch, fanout):
                held -= set(range(first, last))
            assert len(held) <= (fanout - 1) * (math.log(batch + 1, fanout) + 1)
    name = f"s_{uuid.uuid4().hex[:8]}"
    loads.create_table(spark.createDataFrame([], "id bigint, batch_id bigint"), name, ["batch_id"])
    log = micro_batch.BatchLog(spark, str(tmp_path / "batches"))
    for batch in range(14):
        assert micro_batch.load_batch(spark.range(batch * 5, batch * 5 + 5), batch, log, name, "append", fanout=3)
        assert not micro_batch.load_batch(spark.range(99), batch, log, name, "append", fanout=3)
        assert not micro_batch.load_batch(spark.range(99), 0, log, name, "append", fanout=3)
    found = spark.sql(f"SHOW PARTITIONS {name}").collect()
    assert sorted(r[0] for r in found) == ["batch_id=11", "batch_id=12", "batch_id=13", "batch_id=8"]
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(70))


@pytest.mark.parametrize("step", ["overwrite_partitions", "applied"])
def test_a_merge_that_is_interrupted_is_ended(spark, tmp_path, monkeypatch, step):
    name = f"s_{uuid.uuid4().hex[:8]}"
    loads.create_table(spark.createDataFrame([], "id bigint, batch_id bigint"), name, ["batch_id"])
    log = micro_batch.BatchLog(spark, str(tmp_path / "batches"))
    micro_batch.load_batch(spark.range(5), 0, log, name, "append", fanout=2)
    real, calls = getattr(loads, step), []

    def dying(*given, **named):
        calls.append(1)
        if step == "applied" or len(calls) == 2:  # the second overwrite is the merge's
            if step == "overwrite_partitions":
                real(*given, **named)
            raise Killed
        return real(*given, **named)

    with monkeypatch.context() as patch:
        patch.setattr(loads, step, dying)
        with pytest.raises(Killed):
            micro_batch.load_batch(spark.range(5, 10), 1, log, name, "append", fanout=2)
    assert log.highest() == 1 and loads.pending(spark, name) is not None
    assert not micro_batch.load_batch(spark.range(5, 10), 1, log, name, "append", fanout=2)  # the replay ends it
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(10)) and loads.pending(spark, name) is None
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["batch_id=1"]


def test_a_cluster_needs_a_shared_folder():
    def session_of(master, scheme, **settings):
        conf = {"spark.sql.warehouse.dir": "/some/warehouse", **settings}
        system = SimpleNamespace(getScheme=lambda: scheme)
        path = SimpleNamespace(getFileSystem=lambda _: system)
        hadoop = SimpleNamespace(fs=SimpleNamespace(Path=lambda _: path))
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, _jsc=SimpleNamespace(hadoopConfiguration=lambda: None)),
            _jvm=SimpleNamespace(org=SimpleNamespace(apache=SimpleNamespace(hadoop=hadoop))))

    assert session.shared_dir(session_of("local[4]", "file")) == "/some/warehouse/_tidemark"
    assert session.shared_dir(session_of("yarn", "hdfs")) == "/some/warehouse/_tidemark"
    assert session.shared_dir(session_of("yarn", "file", **{"spark.checkpoint.dir": "/shared"})) == "/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(session_of("yarn", "file"))


VALUES = ["x\\y", "it's", "a/b=c", "') --", "é%", None, "\\'"]


@pytest.mark.parametrize("table_format", ["parquet", "orc"])
def test_partition_values_are_only_data(spark, table_format):
    name = f"t_{uuid.uuid4().hex[:10]}"
    old = [(i, p, i, "old") for i, p in enumerate(VALUES)]
    columns = ["k", "v", "load_ts", "part"]
    loads.create_table(spark.createDataFrame(old, SCHEMA).select(columns), name, ["part"], table_format)
    staged = spark.createDataFrame([(9, p, 99, "new") for p in VALUES[:3]] + [(9, "new\\one", 99, "new")], SCHEMA)
    loads.load(staged, name, "overwrite", partition_by=["PART"])
    expected = [(9, p, 99, "new") for p in [*VALUES[:3], "new\\one"]] + old[3:]
    assert rows(spark, name) == sorted(expected, key=str)
    # an upsert that empties every one of these partitions
    moved = spark.createDataFrame([(k, "here", 0, "x") for k in range(3, len(VALUES))], SCHEMA)
    loads.upsert(moved, name, ["k"])
    assert {r.part for r in spark.table(name).select("part").distinct().collect()} == {*VALUES[:3], "new\\one", "here"}
    loads.append(spark.createDataFrame([(50, VALUES[3], 1, "z")], SCHEMA), name)
    assert spark.table(name).filter(F.col("part") == VALUES[3]).count() == 1
    loads.update(spark.createDataFrame([(50, 2)], "k int, v int"), name, ["k"], ["v"])
    assert spark.table(name).filter("k = 50").first().v == 2


@pytest.mark.parametrize("table_format", ["parquet", "orc"])
def test_format_and_layout_stay(spark, table_format):
    name = f"t_{uuid.uuid4().hex[:10]}"
    frame = spark.createDataFrame(OLD, SCHEMA).select("k", "v", "load_ts", "part")
    loads.create_table(frame, name, ["part"], table_format)
    loads.full_load(frame.withColumn("v", frame.v * 2), name)
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert described["Provider"].lower() == table_format
    assert loads._partition_columns(spark, name) == ["part"]
    assert sorted(r.v for r in spark.table(name).collect()) == [20, 40, 60]
    with pytest.raises(ValueError, match="no column part"):
        loads.full_load(frame.drop("part"), name)
    plain = f"t_{uuid.uuid4().hex[:10]}"
    loads.create_table(frame, plain, (), table_format)
    loads.upsert(frame.filter("k = 1").withColumn("v", F.lit(7)), plain, ["k"])
    assert sorted(r.v for r in spark.table(plain).collect()) == [7, 20, 30]


def test_overwrite_names_the_tables_own_partitions(spark, table):
    staged = spark.createDataFrame(OLD[:1], SCHEMA)
    for name, given in ((table(OLD), ["part"]), (table(OLD, ["part"]), ["k"])):
        with pytest.raises(ValueError, match="is partitioned by"):
            loads.load(staged, name, "overwrite", partition_by=given)
        assert spark.table(name).count() == len(OLD)


def test_other_formats_are_refused_before_a_write(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE TABLE {name} (v string) USING text")
    with pytest.raises(ValueError, match="cannot load tables of format text"):
        loads.append(spark.createDataFrame([("x",)], "v string"), name)


def test_a_staged_row_is_worked_out_once(spark, table):
    name = table(OLD, ["part"])
    staged = spark.range(50).selectExpr("cast(id AS int) AS k", "concat('p', floor(rand() * 9)) AS part",
                                        "1 AS v", "'new' AS load_ts")
    loads.overwrite_partitions(staged, name)
    assert spark.table(name).filter("v = 1").count() == 50


def test_old_versions_do_not_pile_up(spark, table):
    name = table([(k, "a", k, "old") for k in range(2000)])
    shared = Path(session.shared_dir(spark).removeprefix("file:"))

    def size():
        return sum(f.stat().st_size for d in shared.glob(f"{name}-*") for f in d.rglob("*") if f.is_file())

    one = size()
    for v in range(10):
        loads.upsert(spark.createDataFrame([(1, "a", v, "new")], SCHEMA), name, ["k"])
    assert size() < 2 * one
    loads.drop_table(spark, name)
    assert size() == 0


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_no_task_holds_both_the_updated_and_the_inserted_rows(spark, table, monkeypatch, partition_by):
    """In one plan Spark gave a task the same keys of both parts, and the sorts of both were in its memory."""
    name = table([(k, "a", k, "old") for k in range(400)] + [(None, "a", 7, "old")], partition_by)
    staged = spark.createDataFrame([(k, "a", -k, "new") for k in range(200, 600)] + [(None, "a", 8, "new")], SCHEMA)
    written, apply = [], loads._apply

    def kinds_by_file(spark, table, path, keep_old):
        files = spark.read.schema(SCHEMA).parquet(path).groupBy(F.col("_metadata.file_name")).agg(F.collect_set("load_ts").alias("kinds"))
        written.extend(sorted(row["kinds"]) for row in files.collect())
        assert not Path(f"{path}-touched".removeprefix("file:")).exists()
        apply(spark, table, path, keep_old)

    monkeypatch.setattr(loads, "_apply", kinds_by_file)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loads.upsert(staged, name, ["k"], update_columns=["v", "load_ts"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert ["old"] in written and ["new"] in written and ["new", "old"] not in written
    expected = [(k, "a", k if k < 200 else -k, "old" if k < 400 else "new") for k in range(600)]
    assert rows(spark, name) == sorted(expected + [(None, "a", 7, "old"), (None, "a", 8, "new")], key=str)


def test_scratch_deletes_what_was_written_inside(spark):
    with session.scratch(spark):
        df = session.materialize(spark.range(5), "inside")
        assert df.count() == 5
        path = df.inputFiles()[0].removeprefix("file://")
    assert not Path(path).exists()


def test_shared_folder_is_never_machine_local():
    def shared(**settings):
        context = SimpleNamespace(getCheckpointDir=lambda: None)
        return session.shared_dir(SimpleNamespace(conf={"spark.sql.warehouse.dir": "s3://w/", **settings}, sparkContext=context))

    assert shared() == "s3://w/_tidemark"
    assert shared(**{"spark.checkpoint.dir": "hdfs://c"}) == "hdfs://c"


def test_merge_statement():
    text = loads.merge_statement("t", "v", ["k"], ["k", "load_ts"], "src.v > 0", ["k"])
    assert text == ("MERGE INTO t AS trg USING v AS src ON trg.`k` = src.`k` AND (src.v > 0) "
                    "WHEN MATCHED THEN UPDATE SET trg.`k` = src.`k` "
                    "WHEN NOT MATCHED THEN INSERT (`k`, `load_ts`) VALUES (src.`k`, src.`load_ts`)")
    only = loads.merge_statement("t", "v", ["k"], ["k"], None, ["a"], "trg.a < 1", inserts=False)
    assert only.endswith("ON trg.`k` = src.`k` WHEN MATCHED AND (trg.a < 1) THEN UPDATE SET trg.`a` = src.`a`")
