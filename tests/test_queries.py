"""Every registered query against its SQL, row by row."""

import pytest
from compare import differences, duck
from conftest import SF

import __spark_entry__ as contract
from tidelog.plans.registered import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    diff, rows, _ = differences(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert diff is None
    assert rows > 0
