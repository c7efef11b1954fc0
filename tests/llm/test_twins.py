"""Every registered query of the training-data operators that SQL can express, against its DuckDB twin."""

import compare
import pytest

import __spark_entry__ as entry
from tallyforge.llm.oracle import oracle_sql

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(DATA)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_training_query_equals_oracle(spark, con, name):
    assert compare.differences(entry.queries()[name](spark, DATA), con, oracle_sql()[name]) == []
