"""Every registered query against its SQL counterpart over whole tables."""

import os

import pytest

import __spark_entry__ as contract
from bridgecheck.check import connect, difference
from bridgecheck.oracle import ORACLE
from bridgecheck.queries import QUERIES

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(contract.queries()) & set(contract.oracle_sql())


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns[:3] == ["dt", "platform", "date"]
    assert found.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    assert difference(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name]) is None
