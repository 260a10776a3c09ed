"""Projections, aggregates, joins and windows over ``sales`` and ``order_sales``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..catalog import sample_rows, table_inventory
from ..functions.labels import loyalty_score
from ..functions.numbers import from_units, money_mean, money_sum, units
from ..functions.udfs import amount_band_udf, loyalty_score_udf
from ..operators import sales as op
from ..operators.cleanse import clean_sales
from ..operators.joins import having_key_in, lookup
from ..operators.merge import passes_rules, rows_after, union_widening
from ..operators.ordered import ordered_scan, running_total_of_peers, top_rows
from ..operators.quality import profile_of_flags
from .registry import query
from .views import (
    CATEGORY_INFO_SQL,
    ORDER_SALES_SQL,
    SALES_COLUMNS,
    SALES_SQL,
    TABLES,
    category_info,
    order_sales,
    sales,
    sales_missing,
    table,
)

WITH_SALES = f"WITH {SALES_SQL} "
WITH_ORDERS = f"WITH {ORDER_SALES_SQL} "
WITH_CATEGORIES = f"WITH {SALES_SQL}, {CATEGORY_INFO_SQL} "
_SUM = "CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE)"
_MEAN = f"{_SUM} / count(*)"


def stores(spark, sf):
    """Store of each supplier."""
    nations = table(spark, sf, "nation")
    return (
        table(spark, sf, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr("s_suppkey as supplier_id", "n_name as store_location")
    )


def categories(spark, sf):
    """Category of each product."""
    return table(spark, sf, "part").selectExpr("p_partkey as product_id", "p_brand as product_category")


# Projections and filters


@query(
    "project_rename",
    WITH_SALES
    + "SELECT transaction_id AS txn_id, customer_id, product_category, quantity, unit_price FROM sales",
)
def project_rename(spark, sf):
    df = sales(spark, sf, "transaction_id", "customer_id", "product_category", "quantity", "unit_price")
    return df.select(F.col("transaction_id").alias("txn_id"), *df.columns[1:])


@query(
    "filter_high_value",
    WITH_SALES
    + "SELECT transaction_id, line_number, product_id, unit_price FROM sales"
    " WHERE unit_price > 3000 AND quantity > 10",
)
def filter_high_value(spark, sf):
    df = sales(spark, sf, "transaction_id", "line_number", "product_id", "quantity", "unit_price")
    return df.filter((F.col("unit_price") > 3000) & (F.col("quantity") > 10)).drop("quantity")


@query(
    "enhanced_sales",
    WITH_SALES
    + "SELECT transaction_id, line_number, quantity * unit_price AS line_total,"
    " quantity * unit_price - coalesce(discount_amount, 0) AS discounted_amount FROM sales",
)
def enhanced_sales(spark, sf):
    df = sales(spark, sf, "transaction_id", "line_number", "quantity", "unit_price", "discount_amount")
    return op.enhance(df).select("transaction_id", "line_number", "line_total", "discounted_amount")


_BAND_SQL = (
    WITH_SALES
    + "SELECT transaction_id, line_number, unit_price, CASE WHEN unit_price < 50 THEN 'Low'"
    " WHEN unit_price < 200 THEN 'Medium' ELSE 'High' END AS amount_category FROM sales"
)


@query("amount_band", _BAND_SQL)
def amount_band_query(spark, sf):
    return op.band(sales(spark, sf, "transaction_id", "line_number", "unit_price"), "unit_price")


@query("udf_amount_band", _BAND_SQL)
def udf_amount_band(spark, sf):
    df = sales(spark, sf, "transaction_id", "line_number", "unit_price")
    return df.withColumn("amount_category", amount_band_udf("unit_price"))


_LOYALTY_SQL = (
    WITH_SALES
    + "SELECT transaction_id, line_number, CAST(CAST(least(100.0, unit_price / 10.0) AS FLOAT) AS DOUBLE)"
    " AS loyalty_score FROM sales"
)


@query("udf_loyalty_score", _LOYALTY_SQL)
def udf_loyalty(spark, sf):
    df = sales(spark, sf, "transaction_id", "line_number", "unit_price")
    score = loyalty_score_udf("unit_price").cast("double")
    return df.select("transaction_id", "line_number", score.alias("loyalty_score"))


@query("loyalty_score", _LOYALTY_SQL)
def loyalty(spark, sf):
    df = sales(spark, sf, "transaction_id", "line_number", "unit_price")
    score = loyalty_score("unit_price").cast("double")
    return df.select("transaction_id", "line_number", score.alias("loyalty_score"))


@query(
    "tax_and_tier",
    WITH_ORDERS
    + "SELECT transaction_id, total_amount, total_amount * 0.1 AS tax,"
    " CASE WHEN total_amount > 200 THEN 'premium' ELSE 'standard' END AS tier FROM order_sales",
)
def tax_and_tier(spark, sf):
    return op.tax_and_tier(order_sales(spark, sf, "transaction_id", "total_amount"))


@query(
    "payroll_tax",
    "SELECT s_suppkey, s_acctbal, s_acctbal / 1000 AS balance_k, s_acctbal * 0.2 AS tax,"
    " 'EUR' AS currency FROM supplier WHERE s_acctbal > 0",
)
def payroll_tax(spark, sf):
    balance = F.col("s_acctbal")
    return (
        table(spark, sf, "supplier")
        .filter(balance > 0)
        .select(
            "s_suppkey",
            "s_acctbal",
            (balance / 1000).alias("balance_k"),
            (balance * (F.lit(0.1) * F.lit(2))).alias("tax"),
            F.lit("EUR").alias("currency"),
        )
    )


@query("loyalty_bonus", "SELECT c_custkey, c_name, c_acctbal * 1.1 AS c_acctbal FROM customer")
def loyalty_bonus(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return op.scale_column(customers, "c_acctbal", 1.1)


@query(
    "status_transition",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'processing' ELSE o_orderstatus END"
    " AS o_orderstatus FROM orders",
)
def status_transition(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return op.transition(orders, "o_orderstatus", "P", "processing")


@query(
    "silver_sales_clean",
    WITH_SALES
    + "SELECT transaction_id, line_number, quantity, total_amount, upper(trim(store_location)) AS store_location"
    " FROM sales WHERE quantity > 0 AND total_amount > 0",
)
def silver_sales_clean(spark, sf):
    return clean_sales(
        sales(spark, sf, "transaction_id", "line_number", "quantity", "total_amount", "store_location")
    )


@query(
    "rule_gate",
    WITH_ORDERS
    + "SELECT transaction_id, total_amount FROM order_sales WHERE total_amount > 0 AND status <> 'P'",
)
def rule_gate(spark, sf):
    df = order_sales(spark, sf, "transaction_id", "total_amount", "status")
    return passes_rules(df, [F.col("total_amount") > 0, F.col("status") != "P"]).drop("status")


@query(
    "sample_by_key",
    "SELECT o_orderkey, o_totalprice FROM orders"
    " WHERE ((o_orderkey % 2147483648) * 2654435761) % 4294967296 < 429496729",
)
def sample_by_key(spark, sf):
    return sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 0.1)


# Aggregates


@query(
    "category_summary",
    WITH_SALES
    + f"SELECT product_category, {_SUM} AS total_revenue, {_MEAN} AS avg_transaction,"
    " count(*) AS transaction_count, max(total_amount) AS max_transaction,"
    " min(total_amount) AS min_transaction FROM sales GROUP BY 1",
)
def category_summary(spark, sf):
    """Lines fold per product before the join, so a best-selling product costs one row."""
    per_product = op.fold(sales(spark, sf, "product_id", "total_amount"), ["product_id"])
    grouped = op.unfold(per_product.join(categories(spark, sf), "product_id"), ["product_category"])
    return grouped.orderBy(F.desc("total_revenue"))


@query(
    "daily_store_summary",
    WITH_SALES
    + f"SELECT CAST(transaction_date AS VARCHAR) AS date, store_location, {_SUM} AS total_revenue,"
    f" {_MEAN} AS avg_transaction, count(*) AS transaction_count, max(total_amount) AS max_transaction,"
    " min(total_amount) AS min_transaction FROM sales GROUP BY transaction_date, store_location",
)
def daily_store_summary(spark, sf):
    lines = sales(spark, sf, "transaction_date", "supplier_id", "total_amount").withColumnRenamed("transaction_date", "date")
    return op.summarize_by(lines, {"supplier_id": stores(spark, sf)}, ["date", "store_location"])


_DAILY_SQL = (
    WITH_SALES
    + f"SELECT CAST(transaction_date AS VARCHAR) AS date, upper(store_location) AS store_location,"
    f" {_SUM} AS revenue, count(*) AS transactions FROM sales WHERE quantity > 0"
    " GROUP BY transaction_date, upper(store_location)"
)


@query("silver_daily_sales", _DAILY_SQL)
def silver_daily_sales(spark, sf):
    lines = sales(spark, sf, "transaction_date", "supplier_id", "total_amount", "quantity").filter("quantity > 0")
    named = stores(spark, sf).withColumn("store_location", F.upper("store_location"))
    return op.revenue_by(lines.withColumnRenamed("transaction_date", "date"), {"supplier_id": named}, ["date", "store_location"])


@query(
    "daily_summary",
    "SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date,"
    " CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,"
    " count(*) AS transactions FROM lineitem GROUP BY CAST(l_shipdate AS DATE)",
)
def daily_summary(spark, sf):
    df = sales(spark, sf, "transaction_date", "total_amount")
    return op.revenue(df, [F.col("transaction_date").alias("date")])


@query(
    "sales_global",
    WITH_SALES
    + f"SELECT {_SUM} AS total_revenue, {_MEAN} AS avg_transaction, count(*) AS transaction_count,"
    " max(total_amount) AS max_transaction, min(total_amount) AS min_transaction FROM sales",
)
def sales_global(spark, sf):
    return op.summarize(sales(spark, sf, "total_amount"), [])


@query(
    "region_rep_summary",
    WITH_SALES
    + "SELECT store_location, supplier_id, CAST(sum(quantity) AS DOUBLE) AS total_quantity,"
    f" {_MEAN} AS avg_amount, count(transaction_id) AS sales_count FROM sales GROUP BY 1, 2",
)
def region_rep_summary(spark, sf):
    """Per-supplier totals first; the store name is joined to the folded rows."""
    lines = sales(spark, sf, "supplier_id", "quantity", "total_amount")
    per_rep = lines.groupBy("supplier_id").agg(
        F.sum("quantity").alias("total_quantity"),
        money_mean("total_amount").alias("avg_amount"),
        F.count("*").alias("sales_count"),
    )
    return per_rep.join(stores(spark, sf), "supplier_id").select(
        "store_location", "supplier_id", "total_quantity", "avg_amount", "sales_count"
    )


@query(
    "discounted_revenue",
    "SELECT l_returnflag AS return_flag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))"
    " * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue, count(*) AS transactions"
    " FROM lineitem GROUP BY 1",
)
def discounted_revenue(spark, sf):
    """Amounts of four decimals, added up as they are."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("return_flag"),
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("amount"),
    )
    return op.revenue(lines, ["return_flag"], "amount")


@query(
    "revenue_share",
    WITH_SALES
    + f"SELECT product_category, customer_segment, count(*) AS transaction_count, {_MEAN} AS avg_amount,"
    f" {_SUM} AS total_revenue, {_SUM} * 100.0 /"
    " CAST(sum(sum(CAST(total_amount AS DECIMAL(18,2)))) OVER () AS DOUBLE) AS revenue_percentage"
    " FROM sales GROUP BY 1, 2",
)
def revenue_share(spark, sf):
    df = sales(spark, sf, "product_category", "customer_segment", "total_amount")
    grouped = op.summarize(df, ["product_category", "customer_segment"])
    shared = op.share_of_total(grouped, "total_revenue", "revenue_percentage")
    return shared.select(
        "product_category",
        "customer_segment",
        "transaction_count",
        F.col("avg_transaction").alias("avg_amount"),
        "total_revenue",
        "revenue_percentage",
    ).orderBy(F.desc("total_revenue"))


@query(
    "monthly_trend",
    "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter,"
    " CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS transactions,"
    " CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS monthly_revenue"
    " FROM lineitem GROUP BY 1, 2, 3",
)
def monthly_trend(spark, sf):
    day = F.col("transaction_date")
    keys = [F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month")]
    df = sales(spark, sf, "transaction_date", "total_amount")
    return op.revenue(df, keys, name="monthly_revenue").orderBy("year", "month")


_LIFETIME_SQL = (
    "SELECT o_custkey AS customer_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS lifetime_value,"
    " count(*) AS total_transactions, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_transaction,"
    " CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_transaction_amount"
    " FROM orders GROUP BY 1"
)


def _lifetime(spark, sf):
    return op.lifetime(order_sales(spark, sf, "customer_id", "total_amount", "transaction_date"))


@query("customer_lifetime", _LIFETIME_SQL)
def customer_lifetime(spark, sf):
    return _lifetime(spark, sf)


@query("top_customers", _LIFETIME_SQL + " ORDER BY lifetime_value DESC, customer_id LIMIT 10")
def top_customers(spark, sf):
    return _lifetime(spark, sf).orderBy(F.desc("lifetime_value"), "customer_id").limit(10)


@query("group_count", "SELECT o_orderpriority, count(*) AS order_count FROM orders GROUP BY 1")
def group_count(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("order_count"))


@query(
    "region_avg_filtered",
    WITH_ORDERS + f"SELECT store_location, {_MEAN} AS avg_amount FROM order_sales"
    " WHERE total_amount > 100000 GROUP BY 1",
)
def region_avg_filtered(spark, sf):
    df = order_sales(spark, sf, "store_location", "total_amount").filter("total_amount > 100000")
    return df.groupBy("store_location").agg(money_mean("total_amount").alias("avg_amount"))


@query(
    "category_region",
    WITH_SALES
    + f"SELECT product_category, store_location, {_SUM} AS revenue, count(*) AS transactions"
    " FROM sales GROUP BY 1, 2",
)
def category_region(spark, sf):
    lines = sales(spark, sf, "product_id", "supplier_id", "total_amount")
    dimensions = {"supplier_id": stores(spark, sf), "product_id": categories(spark, sf)}
    return op.revenue_by(lines, dimensions, ["product_category", "store_location"])


@query(
    "watermark_max",
    "SELECT CAST(max(l_shipdate) AS VARCHAR) AS newest_time, max(l_orderkey) AS newest_id FROM lineitem",
)
def watermark_max(spark, sf):
    df = sales(spark, sf, "event_time", "transaction_id")
    newest = F.date_format(F.max("event_time"), "yyyy-MM-dd HH:mm:ss")
    return df.agg(newest.alias("newest_time"), F.max("transaction_id").alias("newest_id"))


@query(
    "null_profile",
    WITH_SALES
    + "SELECT column_name, null_count, round(null_count * 100.0 / (SELECT count(*) FROM sales), 2)"
    " AS null_percentage FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM sales"
        for c in SALES_COLUMNS
    )
    + ")",
)
def null_profile_query(spark, sf):
    return profile_of_flags(sales_missing(spark, sf))


@query(
    "tumbling_weekly",
    WITH_SALES
    + "SELECT CAST(CAST(time_bucket(INTERVAL '7 days', event_time, TIMESTAMP '1970-01-01') AS DATE) AS VARCHAR)"
    f" AS week_start, product_category, {_SUM} AS weekly_revenue, count(*) AS weekly_transactions"
    " FROM sales GROUP BY 1, 2",
)
def tumbling_weekly(spark, sf):
    lines = sales(spark, sf, "event_time", "product_id", "total_amount")
    weeks = lines.withColumn("week_start", F.to_date(F.window("event_time", "7 days")["start"]))
    named = {"name": "weekly_revenue", "count": "weekly_transactions"}
    return op.revenue_by(weeks, {"product_id": categories(spark, sf)}, ["week_start", "product_category"], **named)


@query(
    "view_total_amount",
    WITH_SALES
    + "SELECT transaction_id, line_number, quantity * unit_price AS computed_total FROM sales"
    " WHERE quantity >= 25",
)
def view_total_amount(spark, sf):
    """A named view with a computed column, read through SQL."""
    df = sales(spark, sf, "transaction_id", "line_number", "quantity", "unit_price")
    own = uuid.uuid4().hex  # two runs in one session do not meet
    base, view = f"sales_base_{own}", f"sales_with_total_{own}"
    df.createOrReplaceTempView(base)
    spark.sql(
        f"CREATE TEMPORARY VIEW {view} AS SELECT *, quantity * unit_price AS computed_total,"
        f" current_date() AS report_date FROM {base}"
    )
    result = spark.sql(f"SELECT transaction_id, line_number, computed_total FROM {view} WHERE quantity >= 25")
    spark.catalog.dropTempView(view)
    spark.catalog.dropTempView(base)
    return result


@query(
    "table_inventory",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS record_count FROM {t}" for t in TABLES),
)
def table_inventory_query(spark, sf):
    return table_inventory(spark, {t: table(spark, sf, t) for t in TABLES})


# Joins


@query(
    "category_sales",
    WITH_CATEGORIES
    + f"SELECT department, product_category, {_SUM} AS category_revenue, count(*) AS category_transactions"
    " FROM sales JOIN category_info ON category = product_category GROUP BY 1, 2",
)
def category_sales(spark, sf):
    """Lines fold per product, products join their category, and partial rows fold again."""
    per_product = op.fold(sales(spark, sf, "product_id", "total_amount"), ["product_id"])
    per_category = op.unfold(per_product.join(categories(spark, sf), "product_id"), ["product_category"])
    known = category_info(spark, sf)
    return per_category.join(known, F.col("product_category") == F.col("category")).select(
        "department",
        "product_category",
        F.col("total_revenue").alias("category_revenue"),
        F.col("transaction_count").alias("category_transactions"),
    )


@query(
    "enrich_left_broadcast",
    WITH_CATEGORIES
    + "SELECT transaction_id, line_number, product_category, department, margin FROM sales"
    " LEFT JOIN category_info ON category = product_category",
)
def enrich_left_broadcast(spark, sf):
    df = sales(spark, sf, "transaction_id", "line_number", "product_category")
    return lookup(df, category_info(spark, sf), "product_category", "category")


@query(
    "dept_revenue",
    WITH_CATEGORIES
    + f"SELECT department, {_SUM} AS dept_revenue FROM sales JOIN category_info"
    " ON category = product_category GROUP BY 1",
)
def dept_revenue(spark, sf):
    lines = op.fold(sales(spark, sf, "product_id", "total_amount"), ["product_id"])
    per_category = op.refold(lines.join(categories(spark, sf), "product_id"), ["product_category"])
    joined = lookup(per_category, category_info(spark, sf), "product_category", "category", "inner")
    return op.unfold_revenue(joined, ["department"], "dept_revenue").drop("transactions").orderBy(F.desc("dept_revenue"))


@query(
    "dept_segment",
    WITH_CATEGORIES
    + f"SELECT department, customer_segment, {_SUM} AS revenue, count(*) AS transactions"
    " FROM sales JOIN category_info ON category = product_category"
    " WHERE total_amount > 50000 GROUP BY 1, 2",
)
def dept_segment(spark, sf):
    df = sales(spark, sf, "product_category", "customer_segment", "total_amount")
    large = df.filter("total_amount > 50000")
    joined = lookup(large, category_info(spark, sf), "product_category", "category", "inner")
    return op.revenue(joined, ["department", "customer_segment"]).orderBy(F.desc("revenue"))


@query(
    "self_key_semi",
    WITH_ORDERS
    + "SELECT transaction_id, customer_id, total_amount FROM order_sales WHERE customer_id IN"
    " (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)",
)
def self_key_semi(spark, sf):
    df = order_sales(spark, sf, "transaction_id", "customer_id", "total_amount")
    return having_key_in(df, df.filter("total_amount > 450000"), "customer_id")


# Ordered windows


@query(
    "rank_in_store",
    WITH_ORDERS
    + "SELECT transaction_id, store_location, total_amount,"
    " rank() OVER (PARTITION BY store_location ORDER BY total_amount DESC) AS rank_in_store,"
    " row_number() OVER (PARTITION BY store_location ORDER BY total_amount DESC, transaction_id)"
    " AS row_num_in_store FROM order_sales",
)
def rank_in_store(spark, sf):
    df = order_sales(spark, sf, "transaction_id", "store_location", "total_amount")
    return ordered_scan(
        df,
        ["store_location"],
        ["-total_amount", "transaction_id"],
        rank="rank_in_store",
        row_number="row_num_in_store",
    )


@query(
    "rank_family",
    "SELECT o_orderkey, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,"
    " dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS date_rank,"
    " lead(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)"
    " AS next_price FROM orders",
)
def rank_family(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("order_date"), "o_totalprice"
    )
    placed = ordered_scan(
        orders,
        ["o_orderpriority"],
        ["order_date", "o_orderkey"],
        dense_rank="date_rank",
        following={"next_price": "o_totalprice"},
    )
    return placed.drop("o_totalprice")


@query(
    "running_total",
    WITH_ORDERS
    + "SELECT transaction_id, store_location, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) OVER"
    " (PARTITION BY store_location ORDER BY transaction_date, transaction_id"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM order_sales",
)
def running_total(spark, sf):
    df = order_sales(spark, sf, "transaction_id", "store_location", "transaction_date", "total_amount")
    totals = ordered_scan(
        df,
        ["store_location"],
        ["transaction_date", "transaction_id"],
        running={"running_total": units("total_amount")},
    )
    return totals.select("transaction_id", "store_location", from_units("running_total").alias("running_total"))


@query(
    "running_total_range",
    WITH_ORDERS
    + "SELECT transaction_id, customer_id, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) OVER"
    " (PARTITION BY customer_id ORDER BY transaction_date) AS DOUBLE) AS running_total FROM order_sales",
)
def running_total_range(spark, sf):
    df = order_sales(spark, sf, "transaction_id", "customer_id", "transaction_date", "total_amount")
    totals = running_total_of_peers(df, ["customer_id"], "transaction_date", units("total_amount"))
    return totals.select("transaction_id", "customer_id", from_units("running_total").alias("running_total"))


@query(
    "top3_per_segment",
    WITH_ORDERS
    + "SELECT customer_id, customer_segment, total_amount, CAST(customer_rank AS INTEGER) AS customer_rank,"
    " CAST(running_total AS DOUBLE) AS running_total FROM (SELECT *,"
    " row_number() OVER w AS customer_rank, sum(CAST(total_amount AS DECIMAL(18,2))) OVER"
    " (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total FROM order_sales"
    " WINDOW w AS (PARTITION BY customer_segment ORDER BY total_amount DESC, transaction_id))"
    " WHERE customer_rank <= 3",
)
def top3_per_segment(spark, sf):
    """The cut to three rows comes first; the running total then sees three rows per segment."""
    df = order_sales(spark, sf, "transaction_id", "customer_id", "customer_segment", "total_amount")
    best = top_rows(df, ["customer_segment"], ["-total_amount", "transaction_id"], 3, "customer_rank")
    totals = ordered_scan(
        best,
        ["customer_segment"],
        ["customer_rank"],
        running={"running_total": units("total_amount")},
        max_group_rows=None,
    )
    return totals.drop("transaction_id").withColumn("running_total", from_units("running_total"))


# Unions


@query(
    "union_sources",
    "SELECT 'events' AS source, event_id AS id, value AS amount FROM events UNION ALL"
    " SELECT 'orders', o_orderkey, o_totalprice FROM orders",
)
def union_sources(spark, sf):
    events = table(spark, sf, "events").selectExpr("'events' as source", "event_id as id", "value as amount")
    orders = table(spark, sf, "orders").selectExpr(
        "'orders' as source", "o_orderkey as id", "o_totalprice as amount"
    )
    return events.unionByName(orders)


@query(
    "schema_evolution_union",
    "SELECT o_orderkey AS id, o_totalprice AS amount, NULL AS event_type FROM orders UNION ALL"
    " SELECT event_id, value, event_type FROM events",
)
def schema_evolution_union(spark, sf):
    orders = table(spark, sf, "orders").selectExpr("o_orderkey as id", "o_totalprice as amount")
    events = table(spark, sf, "events").selectExpr("event_id as id", "value as amount", "event_type")
    return union_widening([orders, events])


@query(
    "append_duplicates_report",
    "SELECT event_id, 2::BIGINT AS copies FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'",
)
def append_duplicates_report(spark, sf):
    """What a blind re-append of the newest half of the events would duplicate."""
    events = table(spark, sf, "events").select("event_id", "ts")
    retried = events.unionByName(rows_after(events, "ts", F.to_timestamp_ntz(F.lit("2024-01-15")), inclusive=True))
    return retried.groupBy("event_id").agg(F.count("*").alias("copies")).filter("copies > 1")
