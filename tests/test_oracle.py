"""Every registered query gives DuckDB's rows on the shared tables, to the last digit."""

import pytest
from oracle_check import differences, duck

import __spark_entry__ as driver
from tickwright.checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.queries()) and set(QUERIES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    result = driver.queries()[name](spark, sf_dir)
    assert result.limit(1).count() == 1
    assert differences(result, con, driver.oracle_sql()[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0
