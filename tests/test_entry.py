"""Every registered query against its SQL on the smallest data set."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_of_the_engine_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, connection, name):
    found = difference(spark, connection, contract.queries()[name], contract.oracle_sql()[name], SF_DIR)
    assert found is None, found


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0
