"""Every registered query with SQL equals DuckDB on the same tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import compare, connect

from conftest import SF

SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    got = queries()[name](spark, SF).toPandas()
    assert compare(got, duck.execute(SQL[name]).df()) == ""


def test_entry(spark):
    assert entry(spark).count() == 150


def test_no_query_without_name():
    assert set(SQL) <= set(queries())
