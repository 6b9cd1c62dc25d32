import os

import pytest

import __spark_entry__ as driver
from checks import oracle, registry
from checks.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(registry.build()) == set(oracle.build())
    assert set(registry.build()) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(registry.build()))
def test_query_equals_its_sql(spark, connection, name):
    assert compare(spark, connection, name, SF_DIR) == ""


@needs_data
def test_entry(spark):
    assert driver.entry(spark).columns == ["deviceCategory", "countryIso", "platform", "metric_sum"]
