"""Every query against its SQL twin on the smallest tables."""

import pytest
from conftest import SF

import __spark_entry__ as entry
import verify

NAMES = list(entry.queries())


@pytest.fixture(scope="module")
def con():
    return verify.connect(SF)


@pytest.mark.parametrize("name", [n for n in NAMES if n in entry.oracle_sql()])
def test_equals_sql(spark, con, name):
    assert verify.compare(spark, con, SF, name) is None


@pytest.mark.parametrize("name", [n for n in NAMES if n not in entry.oracle_sql()])
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(NAMES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
