"""File, JSON, API-page and streaming sources, and the layered flows built on them."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame, functions as F

from ..catalog import column_search, ingest_sources, replace_partitions, save_files, save_table, table_inventory
from ..functions.times import instant_from_utc, utc_from_instant
from ..operators import nested, sales as op
from ..operators.ordered import paged_lists
from ..operators.quality import customer_checks
from ..sources.files import (
    file_contents,
    file_manifest,
    ingest_csv,
    ingest_json,
    ingest_parquet,
    with_lineage,
)
from ..streaming.jobs import (
    BatchLog,
    UpsertLog,
    append_files,
    deliver,
    each_batch,
    latest_result,
    new_files,
    rate_columns,
    running_state,
    tumbling,
)
from ..workspace import Storage, durable, new_folder
from . import flows
from .finance import _METRICS_SQL
from .quality import GOLD_ORDERS_SQL, _SCORED_SQL, daily_order_gold
from .registry import query
from .relational import _DAILY_SQL, stores
from .views import (
    JSON_LINES_SCHEMA,
    TABLES,
    campaigns,
    dirty_customers,
    json_lines,
    nested_orders,
    raw_orders,
    sales,
    table,
)


# File formats: a table goes out to files and comes back through the reader under test.


@query("scan_csv", "SELECT event_id, user_id, event_type, value, props FROM events")
def scan_csv(spark, sf):
    path = new_folder(spark, "csv")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    events.write.option("header", "true").option("delimiter", "|").option("escape", '"').csv(path)
    return ingest_csv(spark, path, events.schema, {"delimiter": "|", "escape": '"'})


@query(
    "scan_json",
    "SELECT o_orderkey, o_totalprice, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders",
)
def scan_json(spark, sf):
    path = new_folder(spark, "json")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date")
    )
    save_files(orders, path, "json")
    return ingest_json(spark, path, orders.schema)


@query("scan_parquet_columns", "SELECT l_orderkey, l_extendedprice FROM lineitem")
def scan_parquet_columns(spark, sf):
    return ingest_parquet(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_extendedprice"])


@query(
    "partition_pruned_scan",
    "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders"
    " WHERE year(o_orderdate) = 1998",
)
def partition_pruned_scan(spark, sf):
    """Written by year; the read lists and opens one year only."""
    path = new_folder(spark, "by-year")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year")
    )
    save_files(orders, path, partition_by=["order_year"])
    return ingest_parquet(spark, path).filter("order_year = 1998")


@query(
    "file_manifest",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS record_count, true AS has_files FROM {t}" for t in TABLES),
)
def file_manifest_query(spark, sf):
    """The manifest of every given table, added up over its files."""
    manifests = [
        file_manifest(table(spark, sf, t)).agg(
            F.lit(t).alias("table_name"),
            F.sum("record_count").alias("record_count"),
            F.every(F.col("filename").endswith(".parquet")).alias("has_files"),
        )
        for t in TABLES
    ]
    return reduce(DataFrame.unionByName, manifests)


@query("file_size_audit")
def file_size_audit_query(spark, sf):
    """Every file of every given table with its size, its rows and whether it keeps within 10 MB."""
    return reduce(DataFrame.unionByName, [file_contents(table(spark, sf, t)).withColumn("table_name", F.lit(t)) for t in TABLES])


@query(
    "source_lineage",
    "SELECT 'events.parquet' AS source_file, 'event_store' AS source_system, count(*) AS rows,"
    " true AS is_stamped FROM events",
)
def source_lineage(spark, sf):
    events = with_lineage(
        table(spark, sf, "events").select("event_id", "_metadata"), source_file=True, source_system="event_store"
    )
    return events.groupBy("source_file", "source_system").agg(
        F.count("*").alias("rows"), F.every(F.col("ingestion_timestamp").isNotNull()).alias("is_stamped")
    )


@query(
    "rate_projection",
    "SELECT event_id + 3000 AS transaction_id, event_id % 3 + 101 AS product_id,"
    " event_id % 5 + 701 AS customer_id, event_id % 100 + 50 AS amount FROM events",
)
def rate_projection(spark, sf):
    """The projection of the rate stream, over events as ``(timestamp, value)`` rows."""
    rows = table(spark, sf, "events").selectExpr("ts as timestamp", "event_id as value")
    return rate_columns(rows).drop("transaction_date")


# JSON text

_TYPED = (
    "SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 6 = 0 THEN NULL"
    " ELSE o_totalprice END AS amount, o_custkey AS customer_id FROM orders"
)


@query(
    "json_parse_typed",
    "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events",
)
def json_parse_typed(spark, sf):
    events = table(spark, sf, "events").select("event_id", "props")
    return nested.parse_json(events, "props", "k bigint", keep=["event_id"])


@query("json_permissive", _TYPED)
def json_permissive(spark, sf):
    return nested.parse_json(json_lines(spark, sf), "value", JSON_LINES_SCHEMA)


@query("json_drop_malformed", _TYPED + " WHERE o_orderkey % 5 <> 0")
def json_drop_malformed(spark, sf):
    return nested.drop_malformed(json_lines(spark, sf), "value", JSON_LINES_SCHEMA)


@query("json_drop_nulls", _TYPED + " WHERE o_orderkey % 5 <> 0 AND o_orderkey % 6 <> 0")
def json_drop_nulls(spark, sf):
    return nested.drop_incomplete(json_lines(spark, sf), "value", JSON_LINES_SCHEMA)


@query("json_rescue_good", _TYPED + " WHERE o_orderkey % 5 <> 0")
def json_rescue_good(spark, sf):
    parsed = nested.parse_json_with_rescue(json_lines(spark, sf), "value", JSON_LINES_SCHEMA)
    return nested.split_rescued(parsed)[0]


@query(
    "json_rescue_bad",
    "SELECT o_orderkey AS order_id, CAST(NULL AS DOUBLE) AS amount, o_custkey AS customer_id,"
    " '{\"order_id\":' || o_orderkey || ',\"amount\":\"invalid\",\"customer_id\":' || o_custkey || '}'"
    " AS _rescued_data FROM orders WHERE o_orderkey % 5 = 0",
)
def json_rescue_bad(spark, sf):
    parsed = nested.parse_json_with_rescue(json_lines(spark, sf), "value", JSON_LINES_SCHEMA)
    return nested.split_rescued(parsed)[1]


@query("json_props_extract", "SELECT event_id, props->>'$.k' AS k_text FROM events")
def json_props_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k_text"))


@query("json_roundtrip", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def json_roundtrip(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    text = parts.select(F.to_json(F.struct("*")).alias("value"))
    return nested.parse_json(text, "value", "p_partkey bigint, p_name string, p_size int, p_retailprice double")


@query(
    "map_flatten",
    "SELECT p_partkey AS product_id, p_brand AS brand, p_type AS kind, CAST(p_size AS VARCHAR) AS size_text,"
    " 3 AS attributes FROM part",
)
def map_flatten(spark, sf):
    products = table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.create_map(
            F.lit("brand"),
            F.col("p_brand"),
            F.lit("kind"),
            F.col("p_type"),
            F.lit("size"),
            F.col("p_size").cast("string"),
        ).alias("attributes"),
    )
    flat = nested.flatten_attribute(products, "attributes", "brand")
    extra = F.col("extra_info")
    return flat.select(
        "product_id",
        "brand",
        extra["kind"].alias("kind"),
        extra["size"].alias("size_text"),
        F.size(extra).alias("attributes"),
    )


# API responses: products in envelopes of bounded length, landed as JSON files

_ENVELOPE = (
    "page_no bigint, status string, timestamp string, total_records bigint, data array<struct<product_id: bigint,"
    " product_name: string, price: double, attributes: map<string,string>>>"
)


def _land(spark, responses: DataFrame, label: str, schema: str) -> DataFrame:
    path = new_folder(spark, label)
    save_files(responses, path, "json")
    return ingest_json(spark, path, schema)


@query(
    "api_envelope_flatten",
    "SELECT p_partkey AS product_id, p_name AS product_name, p_retailprice AS price, p_brand AS brand,"
    " '2024-01-15 10:00:00' AS api_timestamp, 'products_api' AS source_api FROM part",
)
def api_envelope_flatten(spark, sf):
    parts = table(spark, sf, "part")
    product = F.struct(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("price"),
        F.struct(F.col("p_brand").alias("brand")).alias("attributes"),
    )
    pages = paged_lists(parts, ["p_brand"], ["p_partkey"], product, page_rows=100, name="data")
    responses = pages.select(
        "page_no",
        F.lit("success").alias("status"),
        F.lit("2024-01-15T10:00:00Z").alias("timestamp"),
        F.size("data").cast("bigint").alias("total_records"),
        "data",
    )
    landed = _land(spark, responses, "api", _ENVELOPE)
    flat = nested.flatten_envelope(landed, "data", "timestamp", "products_api")
    stamp = F.date_format(utc_from_instant("api_timestamp"), "yyyy-MM-dd HH:mm:ss")
    branded = flat.withColumns({"brand": F.col("attributes")["brand"], "api_timestamp": stamp})
    return branded.drop("attributes")


_PAGES = "source bigint, page_no bigint, data array<struct<customer_id: bigint, name: string, lifetime_value: double>>"


@query(
    "paged_concat",
    "WITH pages AS (SELECT *, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 3 AS page_no"
    " FROM customer), ends AS (SELECT c_nationkey, min(page_no) AS page_end FROM (SELECT c_nationkey, page_no FROM pages"
    " GROUP BY 1, 2 HAVING count(*) FILTER (c_acctbal > 5000) = 0) GROUP BY 1)"
    " SELECT CAST(c_nationkey AS BIGINT) AS source, page_no, c_custkey AS customer_id, c_name AS name, c_acctbal AS lifetime_value"
    " FROM pages LEFT JOIN ends USING (c_nationkey) WHERE c_acctbal > 5000 AND (page_end IS NULL OR page_no < page_end)",
)
def paged_concat(spark, sf):
    """Every source pages through its customers and shows the rich ones; its first empty page ends it."""
    customer = F.struct(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("lifetime_value"),
    )
    customers = table(spark, sf, "customer")
    full = paged_lists(customers, ["c_nationkey"], ["c_custkey"], customer, page_rows=3, name="data")
    responses = full.select(
        F.col("c_nationkey").cast("bigint").alias("source"),
        "page_no",
        F.filter("data", lambda c: c["lifetime_value"] > 5000).alias("data"),
    )
    landed = _land(spark, responses, "pages", _PAGES)
    return nested.pages_until_empty(landed, "page_no", "data", ["source"])


# Nested orders


@query(
    "order_items_exploded",
    "SELECT l_orderkey, l_partkey AS product_id, l_quantity AS quantity,"
    " l_extendedprice / l_quantity AS unit_price, l_discount AS discount,"
    " l_quantity * (l_extendedprice / l_quantity) * (1.0 - l_discount) AS line_total FROM lineitem",
)
def order_items_exploded(spark, sf):
    return nested.explode_items(nested_orders(spark, sf), keep=["l_orderkey"])


@query(
    "order_items_numbered",
    "SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,"
    " l_quantity, l_discount) AS item_no, l_partkey AS product_id, l_quantity AS quantity FROM lineitem",
)
def order_items_numbered(spark, sf):
    """Each item with its place in its order, as the lists hold them."""
    return nested.numbered_items(nested_orders(spark, sf), ["l_orderkey"]).select("l_orderkey", "item_no", "product_id", "quantity")


@query(
    "order_items_collected",
    "SELECT l_orderkey, page_no, count(*) AS item_count, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY rn)"
    " AS product_ids FROM (SELECT *, (rn - 1) // 1000 AS page_no FROM (SELECT *, row_number() OVER"
    " (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,"
    " l_discount) AS rn FROM lineitem)) GROUP BY 1, 2",
)
def order_items_collected(spark, sf):
    return nested_orders(spark, sf).select(
        "l_orderkey",
        "page_no",
        F.size("items").cast("bigint").alias("item_count"),
        F.array_join(F.transform("items", lambda i: i["product_id"].cast("string")), ",").alias("product_ids"),
    )


@query(
    "item_struct_flatten",
    "SELECT l_orderkey, l_linenumber, l_extendedprice AS base_price,"
    " CASE WHEN l_discount > 0 THEN l_extendedprice * (1 - l_discount) END AS sale_price,"
    " l_suppkey AS warehouse_id, l_quantity AS quantity_available FROM lineitem",
)
def item_struct_flatten(spark, sf):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    items = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.struct(
            price.alias("base_price"),
            F.when(discount > 0, price * (F.lit(1) - discount)).alias("sale_price"),
        ).alias("pricing"),
        F.struct(
            F.col("l_suppkey").alias("warehouse_id"), F.col("l_quantity").alias("quantity_available")
        ).alias("inventory"),
    )
    return items.select("l_orderkey", "l_linenumber", "pricing.*", "inventory.*")


# Layered flows


@query("file_to_gold", _DAILY_SQL)
def file_to_gold(spark, sf):
    raw = sales(spark, sf, "transaction_id", "quantity", "total_amount", "transaction_date", "store_location")
    return flows.daily_store_revenue(raw, flows.LayerFolders(spark, "store-sales"))


@query("csv_file_to_gold", _DAILY_SQL)
def csv_file_to_gold(spark, sf):
    """The raw lines land as a CSV file; store names are joined after cleansing and folding."""
    path = new_folder(spark, "raw-csv")
    lines = sales(spark, sf, "supplier_id", "quantity", "total_amount", "transaction_date")
    save_files(lines, path, "csv")
    raw = ingest_csv(spark, path, lines.schema)
    daily = op.fold(raw.filter("quantity > 0").withColumnRenamed("transaction_date", "date"), ["supplier_id", "date"])
    named = daily.join(stores(spark, sf), "supplier_id").withColumn("store_location", F.upper("store_location"))
    return op.unfold_revenue(named, ["date", "store_location"])


@query("medallion_orders", GOLD_ORDERS_SQL)
def medallion_orders(spark, sf):
    layers = flows.LayerFolders(spark, "orders")
    return flows.daily_completed_orders(raw_orders(spark, sf), layers, daily_order_gold, ["copy_no"])


@query(
    "campaign_flow",
    f"WITH {_METRICS_SQL} SELECT CAST(sum(budget) AS DOUBLE) AS total_budget,"
    " CAST(sum(revenue) AS DOUBLE) AS total_revenue, round(avg(round(raw_roas, 2)), 6) AS avg_roas,"
    " CAST(sum(conversions) AS BIGINT) AS total_conversions FROM metrics",
)
def campaign_flow(spark, sf):
    return flows.campaign_performance(campaigns(spark, sf), flows.LayerFolders(spark, "campaigns"))


@query(
    "quality_flow_run",
    f"WITH {_SCORED_SQL} SELECT 'SUCCESS' AS status, count(*) AS records_input,"
    " count(*) FILTER (quality_status <> 'FAILED') AS records_output,"
    " count(*) FILTER (quality_status = 'FAILED') AS records_failed FROM scored",
)
def quality_flow_run(spark, sf):
    layers = flows.LayerFolders(spark, "customers")
    run = flows.customer_quality(dirty_customers(spark, sf), layers, customer_checks())
    return run.select("status", "records_input", "records_output", "records_failed")


# Streams over the events table


def _event_stream(spark, sf):
    """The events as a file stream; the table may be one file or a folder of files.

    A stream takes a file only through a pattern; this one fits a single name.
    """
    return new_files(spark, f"{sf}/[e]vents.parquet", table(spark, sf, "events").schema)


@query("stream_file_incremental", "SELECT event_id, event_type, value FROM events")
def stream_file_incremental(spark, sf):
    """Two runs on one checkpoint: the second finds no new file and adds nothing."""
    out, checkpoint = new_folder(spark, "landed"), new_folder(spark, "landed-checkpoint")
    for _ in range(2):
        stream = _event_stream(spark, sf).select("event_id", "event_type", "value")
        append_files(stream, out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


@query(
    "stream_tumbling_complete",
    "SELECT CAST(CAST(time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS DATE) AS VARCHAR)"
    " AS window_start, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue,"
    " count(*) AS events FROM events GROUP BY 1, 2",
)
def stream_tumbling_complete(spark, sf):
    stream = _event_stream(spark, sf).withColumn("ts", instant_from_utc("ts"))
    windows = tumbling(stream, "ts", ["event_type"], "value", lateness="1 day")
    result = latest_result(spark, windows, "weekly")
    return result.withColumn("window_start", F.to_date(utc_from_instant("window_start")))


_LATEST_SQL = (
    "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id"
    " ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"
)


@query("stream_upsert_latest", _LATEST_SQL)
def stream_upsert_latest(spark, sf):
    """Newest event of every user, merged batch by batch into an upsert log."""
    stream = _event_stream(spark, sf).select("user_id", "event_id", "ts", "value")
    sink = UpsertLog(spark, new_folder(spark, "latest"), stream.schema, ["user_id"], ["ts", "event_id"])
    each_batch(stream, sink, new_folder(spark, "latest-checkpoint"), "append").awaitTermination()
    return sink.read().drop("ts")


_NEWER = "ts >= timestamp_ntz'2024-01-15 00:00:00'"


def _two_deliveries(spark, sf):
    """The events in the order of their arrival: the newer half comes first, the older one late."""
    events = table(spark, sf, "events")
    return [events.filter(part) for part in (_NEWER, f"not ({_NEWER})")]


@query("stream_upsert_out_of_order", _LATEST_SQL)
def stream_upsert_out_of_order(spark, sf):
    """Older events arrive in a later batch and must not win."""
    columns = ["user_id", "event_id", "ts", "value"]
    parts = [part.select(*columns) for part in _two_deliveries(spark, sf)]
    sink = UpsertLog(spark, new_folder(spark, "latest"), parts[0].schema, ["user_id"], ["ts", "event_id"])
    checkpoint = new_folder(spark, "latest-checkpoint")
    deliver(spark, parts, lambda stream: each_batch(stream, sink, checkpoint, "append"))
    return sink.read().drop("ts")


@query(
    "stream_state_update",
    "SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS lifetime_value, count(*) AS total_transactions,"
    " CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_transaction_amount FROM events GROUP BY 1",
)
def stream_state_update(spark, sf):
    """Keyed state over two batches in update mode; each batch shows the users it changed, the log keeps their last state."""
    parts = _two_deliveries(spark, sf)
    shape = running_state(parts[0], "user_id", "value").schema
    sink = UpsertLog(spark, new_folder(spark, "state"), shape, ["user_id"], ["total_transactions"])
    checkpoint = new_folder(spark, "state-checkpoint")
    deliver(spark, parts, lambda stream: each_batch(running_state(stream, "user_id", "value"), sink, checkpoint, "update"))
    return sink.read()


_EVERY_EVENT = "SELECT event_id, user_id, value FROM events"


@query("stream_batch_recovered", _EVERY_EVENT)
def stream_batch_recovered(spark, sf):
    """The second batch dies behind its write and before its commit; the next run on the checkpoint repeats it."""
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    sink = BatchLog(spark, new_folder(spark, "recovered"), events.schema)
    checkpoint, failed = new_folder(spark, "recovered-checkpoint"), []

    def write_and_die(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(sink.read().count())
            raise RuntimeError("stopped before the commit")

    def run(stream):
        job = each_batch(stream, write_and_die, checkpoint, "append")
        try:
            job.awaitTermination()
        except StreamingQueryException:
            if len(failed) != 1:
                raise
            job = each_batch(stream, write_and_die, checkpoint, "append")
        return job

    deliver(spark, [events.filter(F.col("event_id") % 3 == k) for k in range(3)], run)
    if not failed or sink.batches() != [0, 1, 2]:
        raise RuntimeError(f"the second of three batches should have failed once: {failed}, {sink.batches()}")
    return sink.read()


@query("stream_upsert_compacted", _LATEST_SQL)
def stream_upsert_compacted(spark, sf):
    """Nine deliveries, the oldest events last; every second folder is merged as the log grows, and old folders go."""
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    sink = UpsertLog(spark, new_folder(spark, "compacted"), events.schema, ["user_id"], ["ts", "event_id"], fanout=2)
    checkpoint = new_folder(spark, "compacted-checkpoint")

    def write(batch, batch_id):
        sink(batch, batch_id)
        if batch_id % 3 == 2:
            sink.compact()
            sink.vacuum()

    days = F.dayofmonth("ts")
    parts = [events.filter(F.coalesce(F.floor(days / 4), F.lit(0)) == k) for k in range(8, -1, -1)]
    deliver(spark, parts, lambda stream: each_batch(stream, write, checkpoint, "append"))
    return sink.read().drop("ts")


_DELIVERED = """delivered AS (
  SELECT *, CASE WHEN event_id % 10 = 7 THEN 3 WHEN event_id % 10 = 3 THEN least(due + 1, 3) ELSE due END AS delivery,
    time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') + INTERVAL '7 days' AS window_end
  FROM (SELECT *, (ts >= TIMESTAMP '2024-01-10')::INT + (ts >= TIMESTAMP '2024-01-17')::INT + (ts >= TIMESTAMP '2024-01-24')::INT AS due FROM events)
), marks AS (
  SELECT k AS before, max(ts) - INTERVAL '2 days' AS mark FROM delivered JOIN range(5) r(k) ON delivery < k GROUP BY k
)"""


@query(
    "stream_append_closed_windows",
    f"WITH {_DELIVERED} SELECT CAST(CAST(window_end - INTERVAL '7 days' AS DATE) AS VARCHAR) AS window_start, event_type,"
    " CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS events"
    " FROM delivered LEFT JOIN marks ON before = delivery WHERE (mark IS NULL OR window_end > mark)"
    " AND window_end <= (SELECT mark FROM marks WHERE before = 4) GROUP BY 1, 2",
)
def stream_append_closed_windows(spark, sf):
    """Weekly windows over four deliveries in append mode.

    A window comes out once, when the watermark (two days behind the newest event of all earlier
    triggers) has passed its end. A tenth of the events come one delivery late, and count where their
    window is still open; another tenth come with the last delivery, mostly too late. Open windows stay in the state.
    """
    due = reduce(lambda a, b: a + b, [(F.col("ts") >= F.lit(f"2024-01-{day}").cast("timestamp_ntz")).cast("int") for day in (10, 17, 24)])
    last = F.col("event_id") % 10
    delivery = F.when(last == 7, 3).when(last == 3, F.least(due + 1, F.lit(3))).otherwise(due)
    events = table(spark, sf, "events").filter("ts IS NOT NULL").withColumn("delivery", delivery)
    out, checkpoint = new_folder(spark, "closed"), new_folder(spark, "closed-checkpoint")

    def run(stream):
        windows = tumbling(stream.withColumn("ts", instant_from_utc("ts")), "ts", ["event_type"], "value", lateness="2 days")
        return append_files(windows, out, checkpoint)

    deliver(spark, [events.filter(F.col("delivery") == k).drop("delivery") for k in range(4)], run)
    return spark.read.parquet(out).withColumn("window_start", F.to_date(utc_from_instant("window_start")))


# Several sources, failures, the catalog


@query(
    "fail_fast_load",
    "SELECT 'STOPPED' AS status, '{\"o_orderkey\":' || min(o_orderkey) || ',' AS offending, 0::BIGINT AS rows_written FROM orders",
)
def fail_fast_load(spark, sf):
    """One order among all arrives cut off; the load stops, names its text, and leaves nothing behind."""
    orders, path = table(spark, sf, "orders"), new_folder(spark, "strict")
    first = orders.agg(F.min("o_orderkey")).first()[0]
    text = F.to_json(F.struct("o_orderkey", "o_totalprice"))
    cut = F.when(F.col("o_orderkey") == F.lit(first), F.regexp_extract(text, "^[^,]*,", 0)).otherwise(text)
    strict = nested.parse_json_or_stop(orders.select(cut.alias("text")), "text", "o_orderkey long, o_totalprice double")
    try:
        strict.write.parquet(path)
        status, offending = "LOADED", None
    except PySparkException as error:
        status, offending = "STOPPED", nested.offending_text(error)
    left = spark.read.schema(strict.schema).option("recursiveFileLookup", "true").parquet(path) if Storage(spark).names(path) else strict.limit(0)
    return left.agg(F.lit(status).alias("status"), F.lit(offending).alias("offending"), F.count("*").alias("rows_written"))


_SOURCES_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS source, 'LANDED' AS status, count(*) AS record_count, NULL AS error FROM {t}"
    for name, t in (("shop_csv", "customer"), ("order_json", "orders"), ("event_pages", "events"), ("line_files", "lineitem"))
)


@query(
    "multi_source_ingest",
    f"{_SOURCES_SQL} UNION ALL SELECT 'lost_feed', 'FAILED', NULL, 'PATH_NOT_FOUND'"
    " UNION ALL SELECT 'broken_feed', 'FAILED', NULL, 'USER_RAISED_EXCEPTION' FROM (SELECT count(*) AS n FROM nation) WHERE n > 0",
)
def multi_source_ingest(spark, sf):
    """CSV, JSON lines, pages of an API and columnar files land in one run; a missing and a broken source are set aside."""
    inbox, raw = new_folder(spark, "inbox"), new_folder(spark, "raw")
    customers, orders = table(spark, sf, "customer"), table(spark, sf, "orders").drop("o_orderdate")
    save_files(customers, f"{inbox}/csv", "csv")
    save_files(orders, f"{inbox}/json", "json")
    pages = table(spark, sf, "events").groupBy(F.floor(F.col("event_id") / 500).alias("page")).agg(
        F.collect_list(F.struct("event_id", "user_id", "value")).alias("rows")
    )
    save_files(pages, f"{inbox}/pages", "json")
    page = "page long, rows array<struct<event_id: long, user_id: long, value: double>>"
    sources = {
        "shop_csv": lambda: ingest_csv(spark, f"{inbox}/csv", customers.schema),
        "order_json": lambda: ingest_json(spark, f"{inbox}/json", orders.schema),
        "event_pages": lambda: ingest_json(spark, f"{inbox}/pages", page).select(F.inline("rows")),
        "line_files": lambda: ingest_parquet(spark, f"{sf}/lineitem.parquet"),
        "lost_feed": lambda: ingest_parquet(spark, f"{inbox}/nowhere"),
        "broken_feed": lambda: nested.parse_json_or_stop(table(spark, sf, "nation"), "n_name", "name string"),
    }
    storage = Storage(spark)
    return ingest_sources(
        spark, sources, lambda rows, name: save_files(rows, f"{raw}/{name}"), lambda name: storage.delete(f"{raw}/{name}")
    )


@query(
    "catalog_search",
    "SELECT * FROM (VALUES ('orders', 'o_custkey', 'bigint', false), ('orders', 'o_orderkey', 'bigint', false),"
    " ('orders', 'order_year', 'int', true), ('lines', 'l_orderkey', 'bigint', false), ('lines', 'l_partkey', 'bigint', false),"
    " ('lines', 'l_suppkey', 'bigint', false)) found(table_name, column_name, data_type, is_partition)"
    " JOIN (SELECT 'orders' AS table_name, count(*) AS record_count FROM orders"
    " UNION ALL SELECT 'lines', count(*) FROM lineitem) USING (table_name)",
)
def catalog_search(spark, sf):
    """Columns named like a key or a year, among tables made for it, with the tables' inventory; the tables go again."""
    own = f"stratawork_{uuid.uuid4().hex}_"
    year = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    try:
        save_table(year, f"{own}orders", partition_by=["order_year"])
        save_table(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity"), f"{own}lines")
        found = column_search(spark, "key", f"{own}*").unionByName(column_search(spark, "YEAR", f"{own}*"))
        counts = table_inventory(spark, {t: spark.table(f"{own}{t}") for t in ("orders", "lines")})
        named = found.withColumn("table_name", F.regexp_replace("table_name", own, ""))
        return durable(named.join(counts, "table_name"), "catalog-search")
    finally:
        for t in ("orders", "lines"):
            spark.sql(f"DROP TABLE IF EXISTS {own}{t}")


# Writers


def _own_table(spark, write):
    """What a catalog table of its own holds after ``write``; the table goes, also where ``write`` fails, the rows stay."""
    name = f"stratawork_{uuid.uuid4().hex}"
    try:
        write(name)
        return durable(spark.table(name), "own-table")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@query("table_schema_replaced", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def table_schema_replaced(spark, sf):
    """Overwriting a table replaces its rows and its columns."""
    orders = table(spark, sf, "orders")

    def write(name):
        save_table(orders.select("o_orderkey", "o_totalprice"), name)
        save_table(orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderpriority"), name)

    return _own_table(spark, write)


@query(
    "table_append_duplicates",
    "SELECT event_id, 2::BIGINT AS copies FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'",
)
def table_append_duplicates(spark, sf):
    """A blind re-append of the newest half to a real table, and what it duplicates."""
    events = table(spark, sf, "events").select("event_id", "ts")

    def write(name):
        save_table(events, name)
        save_table(events.filter(_NEWER), name, mode="append")

    return _own_table(spark, write).groupBy("event_id").agg(F.count("*").alias("copies")).filter("copies > 1")


@query(
    "partition_replaced",
    "SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,"
    " CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders WHERE year(o_orderdate) <> 1998 OR o_orderkey % 2 = 0",
)
def partition_replaced(spark, sf):
    """One year is delivered again and replaces its partition; the other years stay as they are."""
    path, price = new_folder(spark, "years"), F.col("o_totalprice")
    orders = table(spark, sf, "orders").select("o_orderkey", price, F.year("o_orderdate").alias("order_year"))
    save_files(orders, path, partition_by=["order_year"])
    again = orders.filter("order_year = 1998 and o_orderkey % 2 = 0").withColumn("o_totalprice", price * 2)
    replace_partitions(again, path, ["order_year"])
    return ingest_parquet(spark, path)
