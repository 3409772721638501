"""Every registered query against its SQL counterpart."""

import pytest
from oracle_check import difference, duck

import __spark_entry__ as contract
from registry.oracles import ORACLES
from registry.queries import registered

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(registered()) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(registered()))
def test_same_result(spark, con, key):
    result = contract.queries()[key](spark, SF_DIR)
    assert difference(result, con, contract.oracle_sql()[key]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 50
