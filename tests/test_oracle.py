"""Every query that has reference SQL agrees with DuckDB on the smallest tables
(the driver runs the same check at sf0.01)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from reelrank.plans.oracle import SQL
from reelrank.plans.queries import QUERIES
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_duckdb(spark, sf_small, con, key):
    ok, msg = compare(queries()[key](spark, sf_small), oracle_sql()[key], con)
    assert ok, msg


def test_every_oracle_key_is_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "avg_rating" in df.columns


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, sf_small, key):
    assert queries()[key](spark, sf_small).count() > 0
