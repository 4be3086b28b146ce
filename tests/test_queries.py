"""Every registered query against its SQL counterpart on the smallest driver tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from orderloom.oracles import ORACLES
from orderloom.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def other_engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_each_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, other_engine, name):
    got = QUERIES[name](spark, str(SF_DIR))
    columns = sorted(got.columns)
    result = other_engine.execute(ORACLES[name])
    place = {column[0]: i for i, column in enumerate(result.description)}
    assert sorted(place) == columns
    wanted = Counter(tuple(row[place[c]] for c in columns) for row in result.fetchall())
    assert wanted
    assert Counter(tuple(row) for row in got.select(*columns).collect()) == wanted


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["delivery_date", "baked_good_type", "total_quantity"]
