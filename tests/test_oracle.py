"""Every registered query against its DuckDB twin, row for row."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = Path(os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01"))

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = contract.queries()[name](spark, str(SF_DIR))
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    actual = [tuple(row) for row in df.collect()]
    assert actual, "the query is empty"
    assert _rows(df.columns, actual) == _rows(columns, expected)
