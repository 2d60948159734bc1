"""Every query with SQL gives the same rows in the other engine, on whole tables."""

import pytest

import __spark_entry__ as contract
from conftest import SMALL
from fleetcheck.compare import compare, connect
from fleetcheck.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows(spark, con, name):
    good, text = compare(con, contract.oracle_sql()[name], contract.queries()[name](spark, SMALL))
    assert good, text


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
