"""Every query against its SQL equivalent on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry
from rondo.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["nation", "customer", "part", "events", "documents"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def normal(rows, columns):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in at) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    if name not in ORACLES:
        assert got
        return
    want = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert got == normal(want.fetchall(), want.columns)


def test_entry(spark):
    assert entry(spark).count() == 431
