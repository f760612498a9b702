"""Every registered query on the smallest tables, against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from txlab.catalog import ORACLE, QUERIES
from tools.check import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    connection = duckdb.connect()
    for f in os.listdir(FOLDER):
        if f.endswith(".parquet"):
            connection.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{FOLDER}/{f}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    result = compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])
    assert result.startswith("ok") and "TYPES" not in result, result


def test_entry(spark):
    assert entry.entry(spark).count() == 2


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert not any("pipeline" in n or n.startswith("op") and n[2:3].isdigit() for n in QUERIES)
