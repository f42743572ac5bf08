"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__
from verification.compare import connect, differences
from verification.oracles import ORACLES
from verification.queries import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, DATA), con, ORACLES[name]) == []


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["date", "platform"]
