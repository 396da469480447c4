"""The pipeline's stages against brute force on their own inputs, and the registered queries against their SQL."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_ops import WORD, brute_components, brute_fingerprint, brute_kept, check_mixing, check_packing
from tidemark.llm import queries
from tidemark.llm.common import on_workers

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and result of every stage."""
    base = tmp_path_factory.mktemp("steps")
    docs, out = on_workers(spark).read.parquet(f"{DATA}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{base}/{i}")
        after = spark.read.parquet(f"{base}/{i}")
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_columns(steps):
    assert all(after.columns == corpus_pipeline.COLUMNS for _, after in steps[:-1])


def test_stages_take_columns_by_place(spark, steps):
    for (_, stage), (before, after) in zip(corpus_pipeline.STAGES, steps):
        twins = before.select("*", F.lit("x").alias("TEXT"), F.lit("y").alias("row"), F.lit(1).alias("Doc_Id"), F.lit("z").alias("text"))
        got = stage(spark, twins, DATA)
        assert got.columns == after.columns and got.count() == after.count()


def test_classifier_stage(spark, steps):
    before, after = steps[0]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = set(rows(after))
    assert kept < set(rows(before))
    good = [r for r in rows(before) if labels.get(r[0]) == 1]
    assert sum(r in kept for r in good) >= 0.97 * len(good)


def test_rule_stage(steps):
    before, after = steps[1]
    given = rows(before)
    assert Counter(rows(after)) == Counter(r for r, kept in zip(given, brute_kept([t for _, t in given])) if kept)


def test_dedup_stage(steps):
    before, after = steps[2]
    fps = {d: brute_fingerprint(t) for d, t in rows(before)}
    root = brute_components(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for d in sorted(fps):
        least.setdefault(root[fps[d]], d)
    assert sorted(d for d, _ in rows(after)) == sorted(least.values())


def test_mixing_stage(steps):
    before, after = steps[3]
    check_mixing(before)
    words = sum(len(WORD.findall(t or "")) for _, t in rows(before))
    mixed = sum(len(WORD.findall(t or "")) for _, t in rows(after))
    assert mixed == pytest.approx(1.5 * words, rel=0.02)
    texts = dict(rows(before))
    whole = [(d, t) for d, t in rows(after) if texts[d] == t]
    assert len(rows(after)) - len(whole) <= 20 and max(Counter(d for d, _ in rows(after)).values()) <= 2


def test_packing_stage(steps):
    before, after = steps[4]
    assert Counter(r["doc_id"] for r in before.collect()).keys() == {r["doc_id"] for r in after.collect()}
    check_packing(before)


def test_run(spark, steps):
    got = corpus_pipeline.run(spark, DATA)
    assert got.count() == steps[-1][1].count()


def comparable(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: "" if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v)
    return sorted(tuple(text(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    df = queries.queries()[name](spark, DATA)
    found = df.collect()
    assert found
    sql = queries.oracle_sql().get(name)
    if sql:
        duck = duckdb.connect()
        for path in Path(DATA).glob("*.parquet"):
            duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        cursor = duck.execute(sql)
        columns = [c[0] for c in cursor.description]
        assert comparable(df.columns, found) == comparable(columns, cursor.fetchall())
