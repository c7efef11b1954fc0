"""Every registered query against its DuckDB twin, over whole tables."""

import compare
import pytest

import __spark_entry__ as entry
from tallyforge.plans import catalog

DATA = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(DATA)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_oracle(spark, con, name):
    assert compare.differences(entry.queries()[name](spark, DATA), con, ORACLE[name]) == []


def test_names_match():
    assert set(catalog.queries()) <= set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 5
