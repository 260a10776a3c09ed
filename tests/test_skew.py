"""Every query again on tables in which one key of each kind holds a third of the rows."""

import duckdb
import pytest

from harness import connect, difference

from stratawork.operators import ordered
from stratawork.plans import catalogue
from stratawork.plans.views import TABLES

QUERIES, ORACLES = catalogue.QUERIES, catalogue.ORACLES

HOT = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey,"
    " CASE WHEN o_orderkey % 3 = 1 THEN TIMESTAMP '1998-06-01' ELSE o_orderdate END AS o_orderdate,"
    " CASE WHEN o_orderkey % 3 = 2 THEN 250000.0 ELSE o_totalprice END AS o_totalprice) FROM t",
    "lineitem": "SELECT * REPLACE (CASE WHEN rowid % 3 = 0 THEN 42 ELSE l_orderkey END AS l_orderkey,"
    " CASE WHEN rowid % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey,"
    " CASE WHEN rowid % 3 = 2 THEN 3 ELSE l_suppkey END AS l_suppkey) FROM t",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 8 ELSE user_id END AS user_id,"
    " CASE WHEN event_id % 3 = 1 THEN 'click' ELSE event_type END AS event_type,"
    " CASE WHEN event_id % 3 = 2 THEN TIMESTAMP '2024-01-09 12:00:00' ELSE ts END AS ts) FROM t",
    "customer": "SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE c_nationkey END AS c_nationkey) FROM t",
    "part": "SELECT * REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'Brand#5' ELSE p_brand END AS p_brand) FROM t",
}
UNCHANGED = [t for t in TABLES if t not in HOT]
# Groups above this are scanned in slices here, so that every ordered query takes that way.
LIMIT = 200


@pytest.fixture(scope="module")
def hot(sf, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    for name in [*HOT, *UNCHANGED]:
        con = duckdb.connect()
        con.execute(f"CREATE TABLE t AS SELECT * FROM '{sf}/{name}.parquet'")
        con.execute(f"COPY ({HOT.get(name, 'SELECT * FROM t')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def con(hot):
    return connect(hot)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, hot, con, name, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_GROUP_ROWS", LIMIT)
    assert difference(QUERIES[name](spark, hot), con, ORACLES[name]) is None
