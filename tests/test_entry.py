import pytest
from conftest import SF

import __spark_entry__ as driver
from compare import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_equals_its_statement(spark, con, name):
    ok, text = compare(spark, con, name, SF)
    assert ok, text


def test_structural_checks_where_keys_repeat(spark):
    larger = SF.replace("0.001", "0.01")
    ok, text = compare(spark, connect(larger), "structural_checks", larger)
    assert ok, text
