"""What the optimizer must make of the queries."""

import re

import pytest
from harness import connect, difference
from pyspark.sql import functions as F

from stratawork.plans import catalogue
from stratawork.operators import joins, sales as op
from stratawork.operators.quality import null_profile
from stratawork.plans.views import sales, table


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


QUERIES = catalogue.QUERIES
LAZY = [
    n
    for n in sorted(QUERIES)
    if not re.match(r"stream_|scan_csv|scan_json|csv_file|table_schema|table_append|partition_replaced|file_to_gold|quality_flow|medallion|campaign_flow|api_|paged|partition_pruned", n)
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, sf, name):
    plan = physical(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if not name.startswith("udf_"):
        assert "Python" not in plan and "ArrowEval" not in plan


def test_filter_and_columns_reach_the_scan(spark, sf):
    df = table(spark, sf, "orders").filter("o_totalprice > 100").select("o_orderkey")
    plan = physical(df)
    assert "GreaterThan(o_totalprice,100.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_views_join_only_what_is_asked_for(spark, sf):
    assert "Join" not in physical(sales(spark, sf, "total_amount", "quantity"))
    plan = physical(sales(spark, sf, "product_category", "total_amount"))
    assert plan.count("Join") == 1 and "o_orderkey" not in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in plan


def test_lines_fold_before_the_join(spark, sf):
    plan = physical(QUERIES["category_summary"](spark, sf))
    assert plan.rindex("partial_sum") > plan.index("Join")


def test_partition_filter_prunes_folders(spark, sf):
    plan = physical(QUERIES["partition_pruned_scan"](spark, sf))
    assert re.search(r"PartitionFilters: \[isnotnull\(order_year#\d+\), \(order_year#\d+ = 1998\)\]", plan)


def test_watermark_is_a_pushed_literal(spark, sf):
    plan = physical(QUERIES["incremental_by_sequence"](spark, sf))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(o_orderkey,\d+\)", plan)


def test_broadcast_only_when_measured_small(spark):
    facts = spark.range(1000).withColumn("d", F.col("id") % 10)
    dimension = spark.range(10).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    assert joins.measured_bytes(dimension) == 10 * (16 + 16) + 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = joins.lookup(facts, dimension, "d", "k")
        assert "BroadcastHashJoin" in physical(small)
        large = joins.lookup(facts, dimension, "d", "k", max_broadcast_bytes=100)
        assert "SortMergeJoin" in physical(large)
        assert small.count() == large.count() == 1000
        assert small.columns == ["id", "d", "name"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_share_of_total_has_no_global_window(spark, sf):
    plan = physical(QUERIES["revenue_share"](spark, sf))
    assert "Window" not in plan and "Subquery" in plan


@pytest.mark.parametrize("name", ["top3_per_segment", "snapshot_as_of", "dedup_keep", "silver_orders"])
def test_cut_per_group_happens_before_the_shuffle(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    limit = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in limit)


def test_series_analytics_share_one_shuffle(spark, sf):
    plan = physical(QUERIES["stock_detailed"](spark, sf))
    # One exchange for the daily fold, one for all windows of the series.
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Sort [symbol") <= 3


def test_top_k_does_not_sort_everything(spark, sf):
    assert "TakeOrderedAndProject" in physical(QUERIES["top_customers"](spark, sf))


def test_null_profile_is_one_scan(spark, sf):
    lines = table(spark, sf, "lineitem")
    assert physical(null_profile(lines)).count("FileScan") == 1


BY_DIMENSION = ("category_region", "daily_store_summary", "silver_daily_sales", "tumbling_weekly")


def test_lines_fold_below_the_first_join(spark, sf, monkeypatch):
    """Where a dimension is too large to be broadcast."""
    monkeypatch.setattr(op, "measured_bytes", lambda df: 1 << 60)
    for name in (*BY_DIMENSION, "dept_revenue"):
        plan = physical(QUERIES[name](spark, sf))
        assert re.search(r"Join(?:(?!Join).)*partial_sum(?:(?!Join).)*lineitem", plan, re.DOTALL), name


def test_lines_meet_small_dimensions_without_a_shuffle(spark, sf):
    for name in BY_DIMENSION:
        plan = physical(QUERIES[name](spark, sf))
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan, name
        # the only exchanges are broadcasts and that of the folded groups
        assert plan.count("Exchange hashpartitioning") == 1, name


@pytest.mark.parametrize("name", BY_DIMENSION)
def test_folded_lines_give_the_same_rows(spark, sf, name, monkeypatch):
    monkeypatch.setattr(op, "measured_bytes", lambda df: 1 << 60)
    assert difference(QUERIES[name](spark, sf), connect(sf), catalogue.ORACLES[name]) is None


def test_stock_needs_no_sorted_aggregate(spark, sf):
    for name in ("stock_summary", "stock_detailed", "user_series_detailed", "avg_close_since"):
        assert "SortAggregate" not in physical(QUERIES[name](spark, sf)), name


def test_change_feed_is_one_scan(spark, sf):
    assert physical(QUERIES["change_feed"](spark, sf)).count("FileScan") == 1


def test_fold_and_unfold_equal_summary(spark, rows):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 5.0), ("b", 1, 2.5), ("b", 1, None)], "g string, k int, total_amount double")
    two_steps = op.unfold(op.fold(df, ["g", "k"]), ["g"])
    assert {r[0]: r[2:] for r in rows(two_steps)} == {r[0]: r[2:] for r in rows(op.summarize(df, ["g"]))}
