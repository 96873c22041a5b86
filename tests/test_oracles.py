"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from workload import extract_queries, file_queries, record_queries
from tests.compare import difference, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    for module in (extract_queries, record_queries, file_queries):
        assert set(module.QUERIES) == set(module.ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    result = driver.queries()[name](spark, SF_DIR)
    assert difference(result, con, driver.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert len(driver.entry(spark).collect()) == 20
