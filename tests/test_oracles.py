"""Every registered query against its SQL oracle on the smallest given tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

DATA = Path("/root/testdata/sf0.001")
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return ""
        return repr(float(value)) if isinstance(value, float) else str(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, str(DATA))
    rows = result.collect()
    if name not in ORACLES:
        assert rows
        return
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert comparable(result.columns, rows) == comparable(columns, cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["job_nm", "ref_date", "ready", "not_ready"]
