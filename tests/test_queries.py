"""Every registered query against its SQL on the smallest data."""

import pytest

import __spark_entry__
from lakeproof.catalog import ORACLES, QUERIES
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert differences(duck, result, ORACLES[name]) == []
    else:
        assert result.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 6 * 14
