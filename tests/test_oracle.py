"""Every query with an SQL counterpart gives what DuckDB gives on the same tables."""

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference

ORACLE = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, folder, con, name):
    assert difference(QUERIES[name](spark, folder), con, ORACLE[name]) is None


def test_every_oracle_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    row = entry(spark).first()
    assert row["n_rows"] > 0 and 0 < row["n_pos"] < row["n_rows"]
