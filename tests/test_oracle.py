"""Every query with a SQL counterpart gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(tables):
    return connect(tables)


def test_every_statement_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_same_rows(spark, duck, tables, name):
    assert difference(QUERIES[name](spark, tables), duck.sql(SQL[name])) is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 150 and len(df.columns) == 61
