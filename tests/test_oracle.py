"""Every registered query gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        assert entry.queries()[name](spark, SF_DIR).count() > 0
    else:
        assert compare(spark, duck, entry.queries()[name], oracle, SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 1
