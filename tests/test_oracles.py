"""Every registered query against its oracle on the smallest scale."""

import os

import pytest

import suite
from suite.base import ORACLES, QUERIES
from suite.check import compare, connect

suite.load_all()
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    difference, _ = compare(spark, duck, SF, name)
    assert difference is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
