"""Every registered query against the same question in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from fixtures import oracle
from fixtures.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
    "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "binary": "BLOB",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def comparable(rows):
    return sorted(tuple("null" if v is None else repr(v) for v in row) for row in rows)


def test_each_query_has_an_oracle():
    """The training-data operators say for themselves where SQL can express them."""
    assert set(QUERIES) == set(oracle.oracle_sql()) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    result = entry_point.queries()[name](spark, SF_DIR)
    expected = duck.sql(entry_point.oracle_sql()[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in result.schema} == types
    got = [tuple(row) for row in result.select(columns).collect()]
    want = expected.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert got, "the fixture should reach every query"
    assert comparable(got) == comparable(want)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
