"""Small inputs with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from stratawork.catalog import distinct_schema_names
from stratawork.functions.labels import amount_band, loyalty_score, performance_tier, risk_level
from stratawork.functions.names import schema_name, schema_name_for
from stratawork.functions.numbers import money_mean, money_sum
from stratawork.functions.udfs import amount_band_udf, loyalty_score_udf
from stratawork.operators import campaigns, cleanse, finance, merge, nested, profile, quality, sales
from stratawork.operators.nested import pages_until_empty
from stratawork.operators.ordered import ordered_scan


def test_campaign_ratios(spark):
    data = [("c4", 15000, 180000, 9500, 750, 82500), ("c0", 0, 0, 0, 0, 0)]
    df = spark.createDataFrame(data, "id string, budget int, impressions int, clicks int, conversions int, revenue int")
    got = {r["id"]: (r["ctr"], r["conversion_rate"], r["roas"]) for r in campaigns.campaign_metrics(df).collect()}
    assert got["c4"] == (5.28, 7.89, 5.5)
    assert got["c0"] == (None, None, None)


def raw_orders(spark):
    data = [
        ("1001", "alice@example.com", "Laptop", "1299.99", "2024-01-15 10:00:00", "completed"),
        ("1002", " bob@example.com ", "Mouse", "29.99", "2024-01-15 11:00:00", "completed"),
        ("1002", "bob@example.com", "Mouse", "29.99", "2024-01-15 11:00:00", "completed"),
        ("1003", "carol@example.com", "Desk", "invalid", "2024-01-16 09:00:00", "completed"),
        ("1004", "dan@example.com", "Lamp", "-5", "no date", "pending"),
        ("bad", "eve@example.com", "Pen", None, None, "pending"),
    ]
    return spark.createDataFrame(data, "order_id string, customer_email string, product string, amount string, order_date string, status string")


def test_clean_orders(spark):
    got = {r["order_id"]: r for r in cleanse.clean_orders(raw_orders(spark)).collect()}
    assert set(got) == {1001, 1002, 1003, 1004, None}
    assert got[1001]["amount"] == 1299.99 and got[1001]["is_valid"]
    assert got[1002]["customer_email"] == "BOB@EXAMPLE.COM"
    assert got[1003]["amount"] is None and got[1003]["is_valid"] is False
    assert got[1004]["amount"] is None and got[1004]["order_date"] is None


def test_quality_score(spark):
    data = [
        (1, "Alice", "alice@example.com", 25, 1500.0),
        (2, "Bob", "invalid-email", 30, 2000.0),
        (3, "Carol", "carol@example.com", -5, 1800.0),
        (4, None, "david@example.com", 28, 2200.0),
        (5, "Eve", "eve@example.com", 35, 0.0),
        (6, "Frank", "frank@example.com", 150, 1900.0),
        (7, None, None, 150, -1.0),
    ]
    df = spark.createDataFrame(data, "customer_id int, name string, email string, age int, lifetime_value double")
    scored = quality.with_quality_score(df, quality.customer_checks()).cache()
    assert {r[0]: r[1] for r in quality.status_counts(scored).collect()} == {"PASSED": 1, "WARNING": 1, "FAILED": 5}
    assert scored.filter("customer_id = 7").first()["quality_issues"] == (
        "FAIL: name is null; FAIL: age out of valid range (0-120)"
    )
    kept, bad = quality.route_by_status(scored)
    assert sorted(r[0] for r in kept.select("customer_id").collect()) == [1, 5]
    assert bad.count() == 5


def test_split_puts_unknown_into_quarantine(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, q int")
    good, bad = quality.split_rows(df, F.col("q") > 0)
    assert [r["id"] for r in good.collect()] == [1]
    assert sorted(r["id"] for r in bad.collect()) == [2, 3]


def test_required_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, name string")
    with pytest.raises(ValueError, match="city"):
        quality.validate_data_quality(df, ["id", "city"])
    good, bad = quality.validate_data_quality(df, ["id"])
    assert (good.count(), bad.count(), bad.schema) == (2, 0, df.schema)
    good, bad = quality.validate_data_quality(df, ["id"], ["name"])
    assert (good.count(), bad.count()) == (1, 1)


def test_enforce_schema(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("v", T.DoubleType())])
    df = spark.createDataFrame([("1", "2.5"), ("x", "1"), (None, "1"), ("2", None)], "id string, v string")
    good, bad = quality.enforce_schema(df, schema, "quarantine")
    assert sorted(tuple(r) for r in good.collect())[0] == (1, 2.5)
    assert {r["_violation"] for r in bad.collect()} == {"id: not int", "id: null"}
    with pytest.raises(Exception, match="id:"):
        quality.enforce_schema(df, schema).collect()
    assert quality.enforce_schema(df.filter("id in ('1', '2')"), schema).count() == 2
    with pytest.raises(ValueError, match="v"):
        quality.enforce_schema(df.drop("v"), schema)
    with pytest.raises(ValueError):
        quality.enforce_schema(df, schema, "ignore")


def test_null_profile_of_empty_frame(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert sorted(tuple(r) for r in quality.null_profile(df).collect()) == [("a", 0, 0.0), ("b", 0, 0.0)]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert sorted(tuple(r) for r in quality.null_profile(df).collect()) == [("a", 1, 33.33), ("b", 2, 66.67)]


def test_null_profile_counts_nan_on_request(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,), (2.0,)], "x double")
    assert quality.null_profile(df).first()["null_count"] == 1
    assert quality.null_profile(df, count_nan=True).first()["null_percentage"] == 50.0


def test_remove_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, t int")
    first = cleanse.remove_duplicates(df, ["k"], "first", ["t"])
    last = cleanse.remove_duplicates(df, ["k"], "last", ["t"])
    assert sorted(r["v"] for r in first.collect()) == ["a", "c"]
    assert sorted(r["v"] for r in last.collect()) == ["b", "c"]
    assert cleanse.remove_duplicates(df, ["k"]).count() == 2
    assert cleanse.remove_duplicates(df.unionByName(df)).count() == 3
    with pytest.raises(ValueError):
        cleanse.remove_duplicates(df, ["k"], "middle")


def test_standardize_and_fill(spark):
    df = spark.createDataFrame([(" Ab ", None), (None, "z")], "a string, b string")
    assert {r["a"] for r in cleanse.standardize_string_columns(df, ["a"]).collect()} == {"AB", None}
    assert {r["a"] for r in cleanse.standardize_string_columns(df, ["a"], "lower", False).collect()} == {" ab ", None}
    assert {r["a"] for r in cleanse.standardize_string_columns(df, ["a"], "none").collect()} == {"Ab", None}
    with pytest.raises(ValueError):
        cleanse.standardize_string_columns(df, ["a"], "title")
    assert {r["b"] for r in cleanse.fill_missing_values(df, "b", "n/a").collect()} == {"n/a", "z"}
    assert {r["b"] for r in cleanse.fill_missing_values(df, "b", "n/a", "a").collect()} == {" Ab ", "z"}
    assert cleanse.fill_missing_values(df, "b") is df


def test_customer_flow(spark):
    data = [
        (1, " ann ", "a@x.org", "us", 10.0),
        (1, " ann ", "a@x.org", "us", 10.0),
        (2, "bo", None, None, None),
        (3, None, "c@x.org", "de", 5.0),
    ]
    df = spark.createDataFrame(data, "customer_id int, name string, email string, country string, total double")
    good, bad = cleanse.clean_customers(
        df,
        upper=["name", "country"],
        fills={"email": "none@x.org", "country": "UNKNOWN", "total": 0.0},
        required=["customer_id", "name"],
    )
    assert sorted(tuple(r) for r in good.collect()) == [
        (1, "ANN", "a@x.org", "US", 10.0),
        (2, "BO", "none@x.org", "UNKNOWN", 0.0),
    ]
    assert [r["customer_id"] for r in bad.collect()] == [3]


def customers(spark, data):
    return spark.createDataFrame(data, "id int, name string, spent double")


def test_upsert_is_idempotent_and_refuses_ambiguity(spark, rows):
    target = customers(spark, [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)])
    source = customers(spark, [(2, "B", 20.0), (4, "d", 4.0)])
    once = merge.upsert(target, source, ["id"])
    assert rows(once) == [(1, "a", 1.0), (2, "B", 20.0), (3, "c", 3.0), (4, "d", 4.0)]
    assert rows(merge.upsert(once, source, ["id"])) == rows(once)
    twice = source.unionByName(customers(spark, [(4, "dd", 40.0)]))
    with pytest.raises(merge.DuplicateSourceKeys):
        merge.upsert(target, twice, ["id"])
    assert (4, "dd", 40.0) in rows(merge.upsert(target, twice, ["id"], order_by=["spent"]))


def products(spark, data):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 15, h)) for i, h in data], "id int, modified timestamp")


def test_watermark_load(spark):
    target = products(spark, [(1, 10), (2, 11), (3, 12)])
    batch = products(spark, [(1, 14), (3, 12), (4, 13), (5, 15)])
    load = merge.load_after_timestamp(target, batch, ["id"], "modified")
    assert load.merged.count() == 5 and load.next_mark() == dt.datetime(2024, 1, 15, 15)
    again = merge.load_after_timestamp(load.merged, batch.limit(0), ["id"], "modified")
    assert again.merged.count() == 5 and again.next_mark() == dt.datetime(2024, 1, 15, 15)
    late = products(spark, [(9, 12)])
    strict = merge.load_after_timestamp(target, late, ["id"], "modified", inclusive=False)
    inclusive = merge.load_after_timestamp(target, late, ["id"], "modified")
    assert (strict.merged.count(), inclusive.merged.count()) == (3, 4)
    first = merge.load_after_timestamp(target.limit(0), batch, ["id"], "modified")
    assert first.merged.count() == 4


def test_rows_that_cannot_be_placed_are_not_lost(spark, rows):
    target = products(spark, [(1, 10), (3, 12)])
    batch = products(spark, [(3, 12), (4, 12)]).unionByName(spark.createDataFrame([(2, None)], "id int, modified timestamp"))
    load = merge.load_after_timestamp(target, batch, ["id"], "modified")
    assert [r[0] for r in rows(load.merged)] == [1, 3, 4]
    assert rows(load.rejected) == [(2, None)]
    events = spark.createDataFrame([("a", 1), ("a", 5), ("a", None), ("b", 1)], "kind string, at int")
    marks = spark.createDataFrame([("a", 3)], "kind string, mark int")
    assert rows(merge.resume_by_partition(events, marks, "kind", "at", "mark")) == [("a", 5), ("a", None), ("b", 1)]
    raw = [("x1", 9.0), ("7", 5.0), ("7", 6.0), ("x2", 3.0)]
    schema = "order_id string, customer_email string, product string, amount string, order_date string, status string"
    table = spark.createDataFrame([(i, "a", "p", str(n), "2024-01-01", "s") for i, n in raw], schema)
    cleaned = cleanse.clean_orders(table, ["amount"])
    assert rows(cleaned, "order_id", "amount", "is_valid") == [(7, 5.0, True), (None, 3.0, False), (None, 9.0, False)]


def test_money_is_added_up_without_rounding_rows(spark):
    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "price double")
        return df.agg(money_sum("price"), money_mean("price")).first()

    assert tuple(map(float, total([0.004] * 3))) == (0.012, 0.004)
    assert float(total([0.1] * 1000)[0]) == 100.0
    assert float(total([9e12, 0.25])[0]) == 9000000000000.25
    assert tuple(total([None])) == (None, None)
    for value in (1e17, 0.1234567, float("nan"), float("inf")):
        with pytest.raises(Exception, match="price: .* does not fit 6 decimals"):
            total([value])
    with pytest.raises(TypeError, match="running sums"):
        df = spark.createDataFrame([(1, 0.5)], "id long, price double")
        ordered_scan(df, ["id"], ["id"], running={"r": F.col("price")})


def test_names_without_a_base_stay(spark, rows):
    users = spark.createDataFrame([("a", "x@b"), ("a", "y@b"), (None, "z@b")], "base_name string, email string")
    named = distinct_schema_names(users)
    assert rows(named, "email", "schema_name") == [("x@b", "a_1"), ("y@b", "a_2"), ("z@b", None)]


def test_pages_of_an_unknown_group_stay(spark, rows):
    pages = spark.createDataFrame([(None, 0, [(1,)]), (None, 1, []), (None, 2, [(2,)]), (5, 0, [(3,)])], "g int, page int, data array<struct<x: int>>")
    assert rows(pages_until_empty(pages, "page", "data", ["g"]), "g", "x") == [(5, 3), (None, 1)]


def test_sequence_load(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    batch = spark.createDataFrame([(3, "x"), (4, "d"), (5, "e"), (6, "f")], "id int, v string")
    assert merge.load_after_sequence(target, batch, "id").count() == 6


def test_load_modes(spark, rows):
    schema = "id int, d date"
    target = spark.createDataFrame([(1, dt.date(2024, 1, 19)), (2, dt.date(2024, 1, 20))], schema)
    source = spark.createDataFrame([(2, dt.date(2024, 1, 20)), (3, dt.date(2024, 1, 20)), (4, dt.date(2024, 1, 21))], schema)

    def load(mode):
        return merge.load(target, source, ["id"], mode=mode, process_date="2024-01-20", date_column="d")

    assert [r[0] for r in rows(load("full"))] == [2, 3, 4]
    assert [r[0] for r in rows(load("incremental"))] == [1, 2, 3]
    with pytest.raises(ValueError):
        load("partial")


def test_checkpoints_keep_other_rows_and_their_type(spark):
    now = dt.datetime(2024, 1, 15)
    stored = spark.createDataFrame(
        [("txn", "watermark", "2024-01-15 12:00:00", now), ("sales", "offset", "9", now)], merge.CHECKPOINT_SCHEMA
    )
    update = spark.createDataFrame([("sales", "offset", "10", now)], merge.CHECKPOINT_SCHEMA)
    state = merge.save_checkpoint(stored, update)
    assert state.count() == 2
    assert merge.checkpoint_value(state, "sales", "offset", "long") == 10
    assert merge.checkpoint_value(state, "txn", "watermark", "timestamp") == dt.datetime(2024, 1, 15, 12)
    assert merge.checkpoint_value(state, "none", "watermark", "timestamp") is None


def test_versions(spark, rows):
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [
            (1, 10, 0, "insert", t),
            (2, 20, 0, "insert", t),
            (3, 30, 0, "insert", t),
            (1, 11, 1, "update", t),
            (2, 20, 2, "delete", t),
            (3, 30, 2, "update", t),
            (4, 40, 2, "insert", t),
            (2, 22, 3, "insert", t),
        ],
        "id int, v int, _version int, _op string, _ts timestamp",
    )
    assert rows(merge.as_of(log, ["id"], 0)) == [(1, 10), (2, 20), (3, 30)]
    assert rows(merge.as_of(log, ["id"], 2)) == [(1, 11), (3, 30), (4, 40)]
    assert rows(merge.as_of(log, ["id"], 3)) == [(1, 11), (2, 22), (3, 30), (4, 40)]
    # Key 3 was rewritten without a change, so it is not in the feed.
    assert rows(merge.change_feed(log, ["id"], 0, 2)) == [
        (1, "update", 11),
        (2, "delete", 20),
        (4, "insert", 40),
    ]
    assert rows(merge.change_feed(log, ["id"], 2, 3)) == [(2, "insert", 22)]
    assert [r["_version"] for r in merge.history(log, 2).collect()] == [3, 2]


def lines(spark):
    data = ['{"order_id":1,"amount":100.5}', '{"order_id":2,"amount":"invalid"}', '{"order_id":4}', "not json"]
    return spark.createDataFrame([(v,) for v in data], "value string")


def test_json_modes(spark):
    schema = "order_id int, amount double"
    df = lines(spark)
    assert nested.parse_json(df, "value", schema).count() == 4
    good, bad = nested.split_rescued(nested.parse_json_with_rescue(df, "value", schema))
    assert sorted(r["order_id"] for r in good.collect()) == [1, 4]
    assert {r["_rescued_data"] for r in bad.collect()} == {'{"order_id":2,"amount":"invalid"}', "not json"}
    assert nested.drop_malformed(df, "value", schema).count() == 2
    assert nested.drop_incomplete(df, "value", schema).count() == 1
    with pytest.raises(Exception, match="MALFORMED"):
        nested.parse_json_or_fail(df, "value", schema).collect()


def test_envelope_pages_and_map(spark):
    page = "page int, at string, data array<struct<id:int,attributes:map<string,string>>>"
    one, two = (1, {"brand": "x", "color": "red"}), (2, {"color": "blue"})
    pages = spark.createDataFrame(
        [(1, "2024-01-15T10:00:00Z", [one]), (2, "2024-01-15T10:00:00Z", [two]), (3, "bad", []), (4, "bad", [one])], page
    )
    assert sorted(r["id"] for r in nested.pages_until_empty(pages, "page", "data").collect()) == [1, 2]
    flat = nested.flatten_envelope(pages.filter("page < 3"), "data", "at", "products")
    assert flat.filter("api_timestamp is not null and source_api = 'products'").count() == 2
    branded = nested.flatten_attribute(flat, "attributes", "brand").orderBy("id").collect()
    assert [r["brand"] for r in branded] == ["x", None]
    assert branded[0]["extra_info"] == {"brand": "x", "color": "red"}


def test_items(spark):
    df = spark.createDataFrame(
        [(1, [(7, 2, 10.0, 0.5), (8, 1, 4.0, 0.0)]), (2, [])],
        "id int, items array<struct<product_id:int,quantity:int,unit_price:double,discount:double>>",
    )
    got = nested.explode_items(df, keep=["id"])
    assert sorted((r["id"], r["line_total"]) for r in got.collect()) == [(1, 4.0), (1, 10.0)]


def prices(spark, closes, symbol="A"):
    data = [(symbol, dt.date(2024, 1, i + 1), c, c, c, c, 100) for i, c in enumerate(closes)]
    return spark.createDataFrame(data, "symbol string, date date, open double, high double, low double, close double, volume long")


def test_returns(spark):
    got = finance.detailed(prices(spark, [100.0, 110.0, 0.0, 99.0])).orderBy("date").collect()
    assert [r["daily_return"] for r in got] == [None, 10.0, -100.0, None]
    assert [r["cumulative_return"] for r in got] == [0.0, 10.0, -100.0, -1.0]
    assert [r["volatility_30d"] for r in got] == [None, None, 77.7817, 77.7817]
    summary = finance.summary(finance.calculate_cumulative_returns(finance.calculate_daily_returns(prices(spark, [100.0, 160.0, 90.0]))))
    row = summary.first()
    assert (row["total_return_pct"], row["final_return_pct"]) == (60.0, -10.0)
    assert row["performance_tier"] == "High Performer"


def test_rolling_frame_counts_rows(spark):
    df = finance.calculate_daily_returns(prices(spark, [1.0, 2.0, 3.0, 4.0]))
    got = finance.calculate_rolling_average(df, 2, "close").orderBy("date").collect()
    assert [r["rolling_average_2d"] for r in got] == [1.0, 1.5, 2.5, 3.5]


def test_stock_validation(spark):
    good = finance.validate_stock_data(prices(spark, [1.0, 2.0]))
    assert good["is_valid"] and good["total_records"] == 2
    data = [
        ("A", dt.date(2024, 1, 1), 1.0, 1.0, 2.0, 1.0, 1),
        ("A", dt.date(2024, 1, 1), 1.0, 2.0, 1.0, -1.0, 1),
        (None, None, 1.0, 1.0, 1.0, None, 1),
    ]
    bad = finance.validate_stock_data(spark.createDataFrame(data, prices(spark, [1.0]).schema))
    assert bad == {
        "total_records": 3,
        "null_counts": {"symbol": 1, "date": 1, "close": 1},
        "negative_prices": 1,
        "invalid_ranges": 1,
        "duplicates": 1,
        "is_valid": False,
    }
    assert finance.validate_stock_data(prices(spark, [1.0]).limit(0))["total_records"] == 0


def test_history_parameters_are_not_pasted(spark):
    df = prices(spark, [1.0, 2.0, 3.0])
    assert finance.price_history(df, "A", "2024-01-02", "2024-01-03").count() == 2
    assert finance.price_history(df, "A' OR '1'='1", "2024-01-01", "2024-01-03").count() == 0


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    assert [tuple(r) for r in finance.histogram(df, "x").collect()] == [(0, 2, 5.0, 5.0)]
    assert finance.histogram(df.limit(0), "x").count() == 0


def test_labels_and_udf_twins(spark):
    values = [(v,) for v in (None, -1.0, 0.0, 49.99, 50.0, 199.99, 200.0, 5000.0)]
    df = spark.createDataFrame(values, "x double").select(
        amount_band("x").alias("a"),
        amount_band_udf("x").alias("b"),
        loyalty_score("x").alias("c"),
        loyalty_score_udf("x").alias("d"),
    )
    got = df.collect()
    assert [r["a"] for r in got] == [None, "Low", "Low", "Low", "Medium", "Medium", "High", "High"]
    assert [(r["a"], r["c"]) for r in got] == [(r["b"], r["d"]) for r in got]
    tiers = spark.createDataFrame([(51.0, 0.5), (50.0, 1.0), (20.0, 2.0), (0.0, 2.1), (None, None)], "r double, v double")
    got = tiers.select(performance_tier("r").alias("t"), risk_level("v").alias("l")).collect()
    assert [r["t"] for r in got] == ["High Performer", "Good Performer", "Positive", "Negative", "Negative"]
    assert [r["l"] for r in got] == ["Low", "Medium", "Medium", "High", None]


def test_schema_names(spark):
    emails = ["First.Last@x.org", "test-user+123@example.com", "plain"]
    want = ["first_last", "test_user_123", "plain"]
    assert [schema_name_for(e) for e in emails] == want
    df = spark.createDataFrame([(e,) for e in emails], "e string").select(schema_name("e").alias("n"))
    assert [r["n"] for r in df.collect()] == want


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,)], "x double").select(F.round("x", 2).alias("r"))
    assert [r["r"] for r in df.collect()] == [1.01, 2.68]


def test_missing_discount_means_full_price(spark):
    df = spark.createDataFrame([(2.0, 5.0, 1.0), (2.0, 5.0, None)], "quantity double, unit_price double, discount_amount double")
    assert [r["discounted_amount"] for r in sales.enhance(df).collect()] == [9.0, 10.0]


def test_run_metrics_and_alert(spark):
    def run(day, total, failed):
        start = dt.datetime(2024, 1, day)
        return profile.run_record(
            spark, f"r{day}", "flow", start, records_input=total, records_output=total - failed, records_failed=failed
        )

    runs = run(15, 1000, 50).unionByName(run(16, 1000, 80)).unionByName(run(17, 1000, 120))
    trend = profile.quality_trend(runs)
    rates = [(float(r["success_rate"]), float(r["failure_rate"])) for r in trend.orderBy("start_time").collect()]
    assert rates == [(95.0, 5.0), (92.0, 8.0), (88.0, 12.0)]
    assert profile.quality_alert(trend).first()["is_alert"] is True
    assert profile.quality_alert(trend, 15).first()["is_alert"] is False
    assert profile.quality_trend(run(18, 0, 0)).first()["success_rate"] is None


def test_partition_profile_and_timing(spark):
    even = profile.partition_profile(spark.range(0, 1000, 1, 4)).first()
    assert (even["partition_count"], even["skew_ratio"], even["is_skewed"]) == (4, 1.0, False)
    measured = profile.monitor_query_performance(spark.range(1000), "count")
    assert measured["rows_processed"] == 1000 and measured["operation"] == "count"
