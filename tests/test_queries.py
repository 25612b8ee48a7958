"""Every registered query with SQL gives the rows of that SQL."""

import pytest
from compare import compare, connect

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], FOLDER) == ""


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
