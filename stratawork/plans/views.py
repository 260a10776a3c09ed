"""Views over the given tables, in Spark and (for the checks) in SQL.

Every view is a fixed function of the stored rows. ``sales`` and ``order_sales`` join only
the dimensions whose columns are asked for, as Spark cannot know that a foreign key never
drops a fact row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.numbers import money_sum
from ..operators.ordered import paged_lists


#: All given tables.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Column -> (table it needs, SQL expression)
_SALES = {
    "transaction_id": ("lineitem", "l_orderkey"),
    "line_number": ("lineitem", "l_linenumber"),
    "product_id": ("lineitem", "l_partkey"),
    "supplier_id": ("lineitem", "l_suppkey"),
    "quantity": ("lineitem", "l_quantity"),
    "unit_price": ("lineitem", "try_divide(l_extendedprice, l_quantity)"),
    "total_amount": ("lineitem", "l_extendedprice"),
    "discount_amount": ("lineitem", "if(l_discount = 0, null, l_extendedprice * l_discount)"),
    "transaction_date": ("lineitem", "cast(l_shipdate as date)"),
    "event_time": ("lineitem", "l_shipdate"),
    "customer_id": ("orders", "o_custkey"),
    "payment_method": ("orders", "o_orderpriority"),
    "customer_segment": ("customer", "c_mktsegment"),
    "product_name": ("part", "p_name"),
    "product_category": ("part", "p_brand"),
    "store_location": ("supplier", "n_name"),
}

SALES_COLUMNS = tuple(_SALES)

SALES_SQL = """sales AS (
  SELECT l_orderkey AS transaction_id, l_linenumber AS line_number, l_partkey AS product_id,
         l_suppkey AS supplier_id, l_quantity AS quantity,
         l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total_amount,
         CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice * l_discount END AS discount_amount,
         CAST(l_shipdate AS DATE) AS transaction_date, l_shipdate AS event_time,
         o_custkey AS customer_id, o_orderpriority AS payment_method,
         c_mktsegment AS customer_segment, p_name AS product_name, p_brand AS product_category,
         n_name AS store_location
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey)"""


def sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Line grain; has no unique key."""
    columns = columns or tuple(_SALES)
    needed = {_SALES[c][0] for c in columns}

    def t(name):
        return table(spark, sf_dir, name)

    df = t("lineitem")
    if "part" in needed:
        df = df.join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    if "supplier" in needed:
        stores = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        df = df.join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
    if needed & {"orders", "customer"}:
        orders = t("orders")
        if "customer" in needed:
            orders = orders.join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return df.selectExpr(*[f"{_SALES[c][1]} as {c}" for c in columns])


def sales_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each row of ``sales`` which of its values are NULL, told where each column lives.

    Tables are joined with their keys and flags alone, so that most of them are below the size up to which Spark
    broadcasts a side by itself.
    """

    def flags(name, *keys):
        own = [f"({expr}) is null as {c}" for c, (t, expr) in _SALES.items() if t == name]
        return table(spark, sf_dir, name).selectExpr(*keys, *own)

    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "n_name is null as store_location")
    stores = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    stores = stores.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).drop("s_nationkey", "n_nationkey")
    customers = flags("customer", "c_custkey")
    orders = flags("orders", "o_orderkey", "o_custkey").join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    df = flags("lineitem", "l_orderkey", "l_partkey", "l_suppkey")
    df = df.join(flags("part", "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    df = df.join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
    df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return df.select(*_SALES)


_ORDER_SALES = {
    "transaction_id": ("orders", "o_orderkey"),
    "customer_id": ("orders", "o_custkey"),
    "total_amount": ("orders", "o_totalprice"),
    "transaction_date": ("orders", "cast(o_orderdate as date)"),
    "status": ("orders", "o_orderstatus"),
    "payment_method": ("orders", "o_orderpriority"),
    "customer_segment": ("customer", "c_mktsegment"),
    "store_location": ("nation", "n_name"),
}

ORDER_SALES_SQL = """order_sales AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, o_totalprice AS total_amount,
         CAST(o_orderdate AS DATE) AS transaction_date, o_orderstatus AS status,
         o_orderpriority AS payment_method, c_mktsegment AS customer_segment,
         n_name AS store_location
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""


def order_sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order grain; ``transaction_id`` is unique."""
    columns = columns or tuple(_ORDER_SALES)
    needed = {_ORDER_SALES[c][0] for c in columns}
    df = table(spark, sf_dir, "orders")
    if needed & {"customer", "nation"}:
        customers = table(spark, sf_dir, "customer")
        if "nation" in needed:
            nations = table(spark, sf_dir, "nation")
            customers = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        df = df.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return df.selectExpr(*[f"{_ORDER_SALES[c][1]} as {c}" for c in columns])


CATEGORY_INFO_SQL = """category_info AS (
  SELECT category, 'D' || right(category, 1) AS department,
         CASE CAST(substr(category, 7) AS INTEGER) % 3
              WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS margin
  FROM (SELECT DISTINCT p_brand AS category FROM part)
  WHERE category NOT IN ('Brand#3', 'Brand#13', 'Brand#23'))"""


def category_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Department and margin class per category; three categories are unknown to it."""
    categories = table(spark, sf_dir, "part").select(F.col("p_brand").alias("category")).distinct()
    known = categories.filter(~F.col("category").isin("Brand#3", "Brand#13", "Brand#23"))
    number = F.substring("category", 7, 10).cast("int") % 3
    return known.select(
        "category",
        F.concat(F.lit("D"), F.right("category", F.lit(1))).alias("department"),
        F.when(number == 0, "Low").when(number == 1, "Medium").otherwise("High").alias("margin"),
    )


CAMPAIGNS_SQL = """campaigns AS (
  SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS impressions,
         count(*) FILTER (event_type = 'click') AS clicks,
         count(*) FILTER (event_type = 'purchase') AS conversions,
         sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase') AS revenue,
         sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'view') AS budget
  FROM events GROUP BY 1, 2)"""


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One campaign per user and day; many have no clicks or no budget."""
    kind = F.col("event_type")
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(
            F.count("*").alias("impressions"),
            F.count_if(kind == "click").alias("clicks"),
            F.count_if(kind == "purchase").alias("conversions"),
            money_sum(F.when(kind == "purchase", F.col("value"))).alias("revenue"),
            money_sum(F.when(kind == "view", F.col("value"))).alias("budget"),
        )
    )


STOCK_SQL = """stock AS (
  SELECT event_type AS symbol, CAST(ts AS DATE) AS date,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2)"""


def stock(spark: SparkSession, sf_dir: str, *extra_keys: str) -> DataFrame:
    """Daily prices per symbol; the partial aggregation folds a hot symbol on the map side.

    Time and id make one number, which a hash aggregate can keep in place; a struct would make every
    task sort its events.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(18,0)")
    moment = micros * F.lit(Decimal(10**19)) + F.col("event_id").cast("decimal(19,0)")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("symbol"), *extra_keys, F.to_date("ts").alias("date"))
        .agg(
            F.min_by("value", moment).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", moment).alias("close"),
            F.count("*").alias("volume"),
        )
    )


RAW_ORDERS_SQL = """raw_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         '  Buyer.' || CAST(o_custkey AS VARCHAR) || '@Example.com ' AS customer_email,
         o_orderpriority AS product,
         CASE WHEN o_orderkey % 10 = 0 THEN 'invalid' WHEN o_orderkey % 13 = 0 THEN NULL
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
         CASE WHEN o_orderkey % 17 = 0 THEN 'not a date'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
              ELSE 'cancelled' END AS status,
         copy_no
  FROM orders, LATERAL (SELECT unnest(CASE WHEN o_orderkey % 7 = 0 THEN [1, 2] ELSE [1] END) AS copy_no))"""


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text orders with bad amounts, missing amounts, bad dates and repeated rows."""
    key = F.col("o_orderkey")
    text_amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    copies = F.when(key % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(
        F.col("o_orderstatus") == "O", "pending"
    )
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("order_id"),
        F.concat(F.lit("  Buyer."), F.col("o_custkey").cast("string"), F.lit("@Example.com ")).alias(
            "customer_email"
        ),
        F.col("o_orderpriority").alias("product"),
        F.when(key % 10 == 0, "invalid").when(key % 13 != 0, text_amount).alias("amount"),
        F.when(key % 17 == 0, "not a date")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
        status.otherwise("cancelled").alias("status"),
        F.explode(copies).alias("copy_no"),
    )


CLEAN_ORDERS_SQL = (
    RAW_ORDERS_SQL
    + """, clean_orders AS (
  SELECT CAST(order_id AS BIGINT) AS order_id, trim(upper(customer_email)) AS customer_email,
         product, TRY_CAST(amount AS DOUBLE) AS amount, TRY_CAST(order_date AS DATE) AS order_date,
         status, coalesce(TRY_CAST(amount AS DOUBLE) > 0, false) AS is_valid
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY copy_no) AS rn FROM raw_orders)
  WHERE rn = 1)"""
)

DIRTY_CUSTOMERS_SQL = """dirty_customers AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE '  ' || c_name || ' ' END AS name,
         CASE WHEN c_custkey % 23 = 0 THEN NULL
              WHEN c_custkey % 11 = 0 THEN 'no-address-' || CAST(c_custkey AS VARCHAR)
              ELSE 'Client.' || CAST(c_custkey AS VARCHAR) || '@Example.com' END AS email,
         CAST(c_custkey % 160 - 10 AS INTEGER) AS age,
         CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN 0.0
              ELSE c_acctbal END AS lifetime_value,
         CASE WHEN c_custkey % 13 = 0 THEN NULL
              ELSE ' ' || lower(c_mktsegment) || ' ' END AS country,
         copy_no
  FROM customer, LATERAL (SELECT unnest(CASE WHEN c_custkey % 31 = 0 THEN [1, 2] ELSE [1] END) AS copy_no))"""


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with missing names, bad addresses, odd ages and repeated rows."""
    key = F.col("c_custkey")
    text_key = key.cast("string")
    copies = F.when(key % 31 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return table(spark, sf_dir, "customer").select(
        key.alias("customer_id"),
        F.when(key % 17 != 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("name"),
        F.when(key % 23 == 0, F.lit(None).cast("string"))
        .when(key % 11 == 0, F.concat(F.lit("no-address-"), text_key))
        .otherwise(F.concat(F.lit("Client."), text_key, F.lit("@Example.com")))
        .alias("email"),
        (key % 160 - 10).cast("int").alias("age"),
        F.when(key % 29 == 0, F.lit(None).cast("double"))
        .when(key % 19 == 0, 0.0)
        .otherwise(F.col("c_acctbal"))
        .alias("lifetime_value"),
        F.when(key % 13 != 0, F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))).alias("country"),
        F.explode(copies).alias("copy_no"),
    )


JSON_LINES_SCHEMA = "order_id bigint, amount double, customer_id bigint"


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON text: every fifth has a text amount, every sixth none."""
    key = F.col("o_orderkey")
    order_id, customer_id = key.alias("order_id"), F.col("o_custkey").alias("customer_id")
    good = F.struct(order_id, F.col("o_totalprice").alias("amount"), customer_id)
    text = F.struct(order_id, F.lit("invalid").alias("amount"), customer_id)
    none = F.struct(order_id, customer_id)
    return table(spark, sf_dir, "orders").select(
        F.when(key % 5 == 0, F.to_json(text))
        .when(key % 6 == 0, F.to_json(none))
        .otherwise(F.to_json(good))
        .alias("value")
    )


CHANGES_SQL = """changes AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, o_totalprice AS total_amount,
         o_orderstatus AS status, 0 AS _version, 'insert' AS _op FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice * 1.1, 'U', 1, 'update' FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, 2, 'delete' FROM orders WHERE o_orderkey % 20 = 0
  UNION ALL
  SELECT o_orderkey + 1000000000000, o_custkey, o_totalprice, 'N', 2, 'insert' FROM orders
  WHERE o_orderkey % 50 = 0)"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of the orders over three versions, from one scan."""
    key, amount, status = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderstatus")

    def entry(version, op, when=None, key=key, amount=amount, status=status):
        made = F.struct(
            key.alias("transaction_id"),
            F.col("o_custkey").alias("customer_id"),
            amount.alias("total_amount"),
            status.alias("status"),
            F.lit(version).alias("_version"),
            F.lit(op).alias("_op"),
            (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(version))).alias("_ts"),
        )
        return made if when is None else F.when(when, made)

    log = F.array(
        entry(0, "insert"),
        entry(1, "update", key % 3 == 0, amount=amount * 1.1, status=F.lit("U")),
        entry(2, "delete", key % 20 == 0),
        entry(2, "insert", key % 50 == 0, key=key + 1_000_000_000_000, status=F.lit("N")),
    )
    entries = table(spark, sf_dir, "orders").select(F.explode(log).alias("c"))
    return entries.filter(F.col("c").isNotNull()).select("c.*")


RUNS_SQL = """runs AS (
  SELECT CAST(ts AS DATE) AS start_time, count(*) AS records_input,
         count(*) FILTER (event_type <> 'error') AS records_output,
         count(*) FILTER (event_type = 'error') AS records_failed
  FROM events GROUP BY 1)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day of events as a run; error events are its failed records."""
    failed = F.col("event_type") == "error"
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("start_time"))
        .agg(
            F.count("*").alias("records_input"),
            F.count_if(~failed).alias("records_output"),
            F.count_if(failed).alias("records_failed"),
        )
    )


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents with an array of items, in pages of bounded length."""
    item = F.struct(
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
        F.col("l_discount").alias("discount"),
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"]
    return paged_lists(table(spark, sf_dir, "lineitem"), ["l_orderkey"], order, item)
