"""Every registered query against its SQL oracle."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
from ledgermill.contract import oracles
from ledgermill.contract import queries as contract

SF_DIR = os.environ.get("CONTRACT_SF_DIR", "/root/testdata/sf0.001")
QUERIES = contract.QUERIES
ORACLES = oracles.ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == ""


def test_flagship_query(spark):
    out = entry_points.entry(spark)
    assert out.columns == ["transaction_channel", "numerator", "denominator", "success_pct"] and out.count() > 0
