"""The sliced way must give what a plain Spark window gives, whatever the skew."""

import random

import pytest
from pyspark.sql import Window, functions as F

from stratawork.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, values repeat, keys and values may be NULL."""
    dice = random.Random(7)
    data = [
        (
            dice.choice(["hot"] * 8 + ["a", "b", None]),
            dice.choice([None] + list(range(20))),
            i,
            dice.choice([None, round(dice.uniform(-50, 50), 2)]),
        )
        for i in range(3000)
    ]
    return spark.createDataFrame(data, "k string, v int, id long, amount double").repartition(6).cache()


def amount():
    return F.col("amount").cast("decimal(18,2)")


@pytest.mark.parametrize("descending", [False, True])
def test_sliced_scan_equals_window(skewed, rows, descending):
    by = F.desc("v") if descending else F.asc("v")
    got = ordered.ordered_scan(
        skewed,
        ["k"],
        ["-v" if descending else "v", "id"],
        row_number="rn",
        running={"total": amount()},
        following={"next_amount": "amount"},
        max_group_rows=50,
    )
    w = Window.partitionBy("k").orderBy(by, "id")
    want = skewed.withColumns(
        {
            "total": F.sum(amount()).over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "next_amount": F.lead("amount").over(w),
            "rn": F.row_number().over(w).cast("long"),
        }
    )
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_offsets_are_broadcast_and_slices_are_not_shuffled_again(skewed):
    df = ordered.ordered_scan(skewed, ["k"], ["id"], running={"t": amount()}, max_group_rows=500)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 2


def test_small_groups_use_plain_window(skewed, plan_of):
    df = ordered.ordered_scan(skewed, ["k"], ["id"], row_number="rn")
    assert "__slice" not in plan_of(df)


def test_hot_group_is_cut_into_slices(skewed, monkeypatch):
    written, durable = [], ordered.durable

    def watched(df, label):
        written.append(durable(df, label))
        return written[-1]

    monkeypatch.setattr(ordered, "durable", watched)
    ordered.ordered_scan(skewed, ["k"], ["id"], row_number="rn", max_group_rows=500).count()
    assert [r[0] for r in written[0].collect()] == ["hot"]
    # keys, input, slices
    sizes = written[2].groupBy("k", "__slice").count()
    sizes = [r["count"] for r in sizes.collect()]
    assert sum(sizes) == skewed.filter("k = 'hot'").count()
    assert len(sizes) > 4 and max(sizes) <= 500


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("limit", [20, 10_000])
def test_ranked(skewed, rows, descending, limit):
    got = ordered.ordered_scan(
        skewed,
        ["k"],
        ["-v" if descending else "v", "id"],
        rank="r",
        dense_rank="d",
        row_number="n",
        max_group_rows=limit,
    )
    by = F.desc("v") if descending else F.asc("v")
    peers, full = Window.partitionBy("k").orderBy(by), Window.partitionBy("k").orderBy(by, "id")
    want = skewed.withColumns(
        {"r": F.rank().over(peers), "d": F.dense_rank().over(peers), "n": F.row_number().over(full)}
    )
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("limit", [5, 10_000])
def test_running_total_of_peers(skewed, rows, limit):
    got = ordered.running_total_of_peers(skewed, ["k"], "v", amount(), "total", max_group_rows=limit)
    w = Window.partitionBy("k").orderBy("v")
    want = skewed.withColumn("total", F.sum(amount()).over(w))
    assert rows(got, *want.columns) == rows(want)


def test_paged_lists_keep_every_row_in_order(skewed):
    pages = ordered.paged_lists(skewed, ["k"], ["id"], F.col("id"), page_rows=100, max_group_rows=200)
    seen = {}
    for row in pages.orderBy("k", "page_no").collect():
        assert len(row["items"]) <= 100
        seen.setdefault(row["k"], []).extend(row["items"])
    want = {}
    for row in skewed.orderBy("id").collect():
        want.setdefault(row["k"], []).append(row["id"])
    assert seen == want


def test_top_rows_thin_out_before_the_shuffle(skewed, plan_of):
    df = ordered.top_rows(skewed, ["k"], ["id"], 3)
    plan = plan_of(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert df.filter("k = 'hot'").count() == 3


@pytest.mark.parametrize("limit", [1, 7, 40, 500])
def test_series_in_blocks_equal_plain_windows(skewed, rows, limit):
    """Lag, first value and a frame of earlier rows, for groups of one block and of many."""

    def compute(df, keys):
        along = Window.partitionBy(*keys).orderBy("v", "id")
        frame = along.rowsBetween(-5, 0)
        return df.withColumns(
            {
                "before": F.lag("amount", 2).over(along),
                "largest": F.max("amount").over(frame),
                "seen": F.count("amount").over(frame),
                "ratio": F.col("amount") - F.col("__head"),
            }
        )

    def run(most):
        return ordered.in_blocks(skewed, ["k"], ["v", "id"], 5, compute, first={"__head": "amount"}, max_group_rows=most)

    got, want = run(limit), run(None)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert "__head" not in got.columns
    assert rows(got) == rows(want)


def test_no_block_holds_more_than_its_share(skewed):
    sizes = []

    def compute(df, keys):
        if "__block" in keys:
            sizes.append(df.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return df.withColumn("before", F.lag("id").over(Window.partitionBy(*keys).orderBy("id")))

    ordered.in_blocks(skewed, ["k"], ["id"], 3, compute, max_group_rows=100).count()
    assert sizes and max(sizes) <= 50 + 3
