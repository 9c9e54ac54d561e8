"""Every registered query against its SQL in DuckDB, on whole tables."""

import pytest
from oracle_check import compare, connect

from reconkit import queries

queries.load()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, folder, con, name):
    assert compare(queries.QUERIES[name](spark, folder), con, queries.ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_returns_rows(spark, folder, name):
    assert queries.QUERIES[name](spark, folder).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["column_name", "compared", "different"]
