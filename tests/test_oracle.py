import os

import pytest

import __spark_entry__ as contract
from tests.compare import differences, open_tables
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    return open_tables(SF_DIR)


def test_every_sync_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert differences(result, db, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
