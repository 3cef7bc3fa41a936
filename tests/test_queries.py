"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.inputs import TABLES
from compare import rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))  # the others have tests of their own
def test_query_equals_sql(spark, database, name):
    frame = queries()[name](spark, FOLDER)
    result = database.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
