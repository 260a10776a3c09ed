"""Every registered query against its SQL on the smallest tables."""

import __spark_entry__ as contract
import pytest
from harness import connect, difference

from stratawork.plans import catalogue

QUERIES, ORACLES = catalogue.QUERIES, catalogue.ORACLES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


#: How files lie on storage is nothing that SQL over their rows can state; test_files.py compares with the files.
ABOUT_FILES = {"file_size_audit", "partition_profile"}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) | ABOUT_FILES


def test_contract_holds_all_queries():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["date", "store_location", "revenue", "transactions"]
    assert df.count() > 0
