"""The registered queries against their SQL, over the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import check

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    """All but those of the corpus operators that SQL cannot express; they are tested beside the operators."""
    without = set(contract.queries()) - set(contract.oracle_sql())
    assert without <= set(contract.LLM_QUERIES) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() == 1000 and "macd_histogram" in frame.columns


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    frame = contract.queries()[name](spark, os.fspath(TABLES))
    result = db.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    got = check.rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert check.differences(got, check.rows(columns, result.fetchall())) == []
    assert got
