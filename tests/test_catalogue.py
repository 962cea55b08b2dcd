"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from profileloom.checks.inputs import TABLES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    return value.replace(tzinfo=None).isoformat() if isinstance(value, datetime.datetime) else repr(value)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    frame = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    result = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    found = sorted(tuple(map(plain, row)) for row in frame.select(*columns).collect())
    assert found == expected


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
