"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from oracle_check import differences, duck

import __spark_entry__ as driver
from viewlog.registry import oracle, queries

QUERIES, SQL = queries.all_queries(), oracle.all_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_all_of_them_are_registered():
    assert set(QUERIES) <= set(driver.queries())
    assert set(SQL) <= set(driver.oracle_sql())


def test_entry_gives_profiles(spark):
    assert driver.entry(spark).count() == 15


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, connection, name):
    assert differences(spark, connection, SF_DIR, QUERIES[name], SQL[name]) == ""
