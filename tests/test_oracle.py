"""Every registered query against its SQL counterpart on the smallest tables."""

import oracle_check
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = oracle_check.connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(driver.queries()))
def test_query_equals_sql(spark, duck, name):
    ok, note = oracle_check.compare(spark, duck, name, SF)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
