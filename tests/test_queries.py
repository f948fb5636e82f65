"""Every registered query beside its SQL on the smallest given tables."""

import os

import duckdb
import pytest

from proofs.check import TABLES, compare
from proofs.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_one_query_alone_has_no_sql():
    assert [n for n, (_, sql) in REGISTRY.items() if sql is None] == []


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql is not None])
def test_query(spark, con, name):
    good, note = compare(spark, con, FOLDER, name)
    assert good, note


def test_entry_needs_no_session_to_import_and_runs(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
