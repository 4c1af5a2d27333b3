"""Every registered query against DuckDB on the given tables."""

import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from sheetstar.plans.catalog import QUERIES
from sheetstar.plans.oracles import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    ours = _sorted_rows(found.columns, found.collect())
    theirs = _sorted_rows(columns, expected.fetchall())
    assert len(ours) == len(theirs)
    assert len(ours) > 0
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not different, different[:3]


def test_entry(spark):
    assert contract.entry(spark).count() == 150
