"""Every query with a SQL twin, on the smallest test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from checks import compare

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_same_rows(spark, duck, name):
    rows = driver.queries()[name](spark, FOLDER).toPandas()
    expected = duck.execute(driver.oracle_sql()[name]).df()
    assert compare.differences(rows, expected) == []


def test_entry(spark):
    assert len(driver.entry(spark).columns) == 54


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
