"""Every registered query with SQL, against DuckDB on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import difference, run_sql

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    got = queries()[name](spark, FOLDER).toPandas()
    assert difference(got, run_sql(SQL[name], FOLDER)) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
