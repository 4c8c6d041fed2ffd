"""Driver contract and oracle agreement on the smallest test data."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

ORACLES = E.oracle_sql()
QUERIES = E.queries()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["doc_id", "summary"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 100


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle_agrees(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_duckdb_available():
    assert duckdb.sql("SELECT 1").fetchall() == [(1,)]
