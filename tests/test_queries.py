"""Every catalogue query against its SQL, on the small tables."""

import pytest
from check_oracles import compare, sql_connection

import __spark_entry__ as driver
from feedloom.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return sql_connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    ok, note = compare(spark, connection, SF, name)
    assert ok, note


def test_driver_contract(spark):
    assert set(driver.queries()) >= set(QUERIES)
    assert set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())
    assert set(ORACLES) <= set(QUERIES)
    frame = driver.entry(spark)
    assert frame.columns == ["feed_name", "link", "title", "published", "feed_pos"]
    assert frame.count() > 0
