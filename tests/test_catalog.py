"""Every query of the catalog against its SQL."""

import pytest

import __spark_entry__ as entry
import check

SQL = entry.oracle_sql()
JOBS = entry.queries()
# Optional parts whose results SQL cannot state; their own tests compare them with plain versions.
WITHOUT_SQL = {name for name in JOBS if name == "pipeline" or name.startswith("op")}


@pytest.fixture(scope="module")
def connection(small):
    return check.connect(small)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(JOBS)
    assert {name for name in JOBS if name not in SQL} <= WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(JOBS))
def test_query_equals_sql(spark, small, connection, name):
    ok, message = check.compare(spark, connection, small, name, JOBS[name], SQL.get(name))
    assert ok, message


def test_entry(spark):
    assert entry.entry(spark).count() == 5
