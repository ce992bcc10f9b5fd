"""Every contract query against its SQL, on the smallest data set."""

import os

import pytest

import __spark_entry__ as contract_entry
from contract import compare, connect
from testbed.oracle import ORACLES
from testbed.queries import QUERIES

SF_DIR = os.environ.get("CONTRACT_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_query_has_sql():
    """The ledger's queries; those of the corpus operators are tested beside them."""
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract_entry.queries().items()
    assert ORACLES.items() <= contract_entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, database, name):
    assert compare(QUERIES[name](spark, SF_DIR), database, ORACLES[name]) == ""


def test_entry(spark):
    result = contract_entry.entry(spark)
    assert result.columns[:2] == ["client", "txnDate"]
    assert len(result.take(1)) == 1
