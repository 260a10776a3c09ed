"""Upserts, watermark and checkpoint loads, versioned reads over orders."""

from __future__ import annotations

import datetime

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import merge
from ..operators.profile import partition_profile, quality_alert, quality_trend
from ..sources.ledger import FileLedger
from ..workspace import Storage, new_folder
from .registry import query
from .views import CHANGES_SQL, ORDER_SALES_SQL, RUNS_SQL, TABLES, changes, order_sales, runs, table

WITH_CHANGES = f"WITH {CHANGES_SQL} "
_CUT = datetime.date(2000, 1, 1)
_COLUMNS = ("transaction_id", "total_amount", "transaction_date", "status")

# Old table: orders before the cut. Delivery: orders from a year earlier on, amounts restated,
# so it holds known keys (updates) and unknown ones (inserts).
_BATCH_SQL = (
    ORDER_SALES_SQL
    + """, loaded AS (
  SELECT transaction_id, total_amount, transaction_date, status FROM order_sales
  WHERE transaction_date < DATE '2000-01-01'),
delivery AS (
  SELECT transaction_id, total_amount * 2 AS total_amount, transaction_date, status FROM order_sales
  WHERE transaction_date >= DATE '1999-01-01'),
merged AS (
  SELECT * FROM delivery UNION ALL
  SELECT * FROM loaded WHERE NOT EXISTS
    (SELECT 1 FROM delivery WHERE delivery.transaction_id = loaded.transaction_id))"""
)
_SHOW = "SELECT transaction_id, total_amount, CAST(transaction_date AS VARCHAR) AS transaction_date, status FROM "


def _loaded(spark, sf):
    return order_sales(spark, sf, *_COLUMNS).filter(F.col("transaction_date") < F.lit(_CUT))


def _delivery(spark, sf):
    start = F.lit(datetime.date(1999, 1, 1))
    batch = order_sales(spark, sf, *_COLUMNS).filter(F.col("transaction_date") >= start)
    return batch.withColumn("total_amount", F.col("total_amount") * 2)


@query("upsert_merge", f"WITH {_BATCH_SQL} {_SHOW} merged")
def upsert_merge(spark, sf):
    return merge.upsert(_loaded(spark, sf), _delivery(spark, sf), ["transaction_id"])


@query("upsert_twice", f"WITH {_BATCH_SQL} {_SHOW} merged")
def upsert_twice(spark, sf):
    """A retried load changes nothing."""
    delivery = _delivery(spark, sf)
    once = merge.upsert(_loaded(spark, sf), delivery, ["transaction_id"])
    return merge.upsert(once, delivery, ["transaction_id"], source_is_unique=True)


@query(
    "incremental_by_timestamp",
    f"WITH {_BATCH_SQL}, fresh AS (SELECT * FROM delivery WHERE transaction_date >="
    " (SELECT max(transaction_date) FROM loaded))"
    f" {_SHOW} (SELECT * FROM fresh UNION ALL SELECT * FROM loaded WHERE transaction_id NOT IN"
    " (SELECT transaction_id FROM fresh))",
)
def incremental_by_timestamp(spark, sf):
    loaded, delivery = _loaded(spark, sf), _delivery(spark, sf)
    return merge.load_after_timestamp(loaded, delivery, ["transaction_id"], "transaction_date").merged


@query(
    "incremental_by_sequence",
    "WITH loaded AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate < DATE '1997-01-01'"
    " AND o_orderpriority = '1-URGENT')"
    " SELECT * FROM loaded UNION ALL SELECT o_orderkey, o_totalprice FROM orders"
    " WHERE o_orderkey > (SELECT max(o_orderkey) FROM loaded)",
)
def incremental_by_sequence(spark, sf):
    orders = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.to_timestamp_ntz(F.lit("1997-01-01"))
    loaded = orders.filter(early & (F.col("o_orderpriority") == "1-URGENT"))
    columns = ["o_orderkey", "o_totalprice"]
    return merge.load_after_sequence(loaded.select(*columns), orders.select(*columns), "o_orderkey")


@query("load_full", f"WITH {_BATCH_SQL} {_SHOW} delivery")
def load_full(spark, sf):
    return merge.load(
        _loaded(spark, sf),
        _delivery(spark, sf),
        ["transaction_id"],
        mode="full",
        process_date="2000-06-15",
        date_column="transaction_date",
    )


@query(
    "load_incremental",
    f"WITH {_BATCH_SQL}, of_day AS (SELECT * FROM delivery WHERE transaction_date = DATE '1999-06-15')"
    f" {_SHOW} (SELECT * FROM of_day UNION ALL SELECT * FROM loaded WHERE transaction_id NOT IN"
    " (SELECT transaction_id FROM of_day))",
)
def load_incremental(spark, sf):
    return merge.load(
        _loaded(spark, sf),
        _delivery(spark, sf),
        ["transaction_id"],
        mode="incremental",
        process_date="1999-06-15",
        date_column="transaction_date",
    )


# Versioned reads

_KEYS = ["transaction_id"]


def _as_of_sql(version: int, name: str) -> str:
    return (
        f"{name} AS (SELECT transaction_id, customer_id, total_amount, status FROM (SELECT *,"
        " row_number() OVER (PARTITION BY transaction_id ORDER BY _version DESC) AS rn FROM changes"
        f" WHERE _version <= {version}) WHERE rn = 1 AND _op <> 'delete')"
    )


@query("snapshot_as_of", WITH_CHANGES + f", {_as_of_sql(1, 's')} SELECT * FROM s")
def snapshot_as_of(spark, sf):
    return merge.as_of(changes(spark, sf), _KEYS, 1)


@query("snapshot_latest", WITH_CHANGES + f", {_as_of_sql(2, 's')} SELECT * FROM s")
def snapshot_latest(spark, sf):
    return merge.as_of(changes(spark, sf), _KEYS, 2)


@query(
    "table_history",
    WITH_CHANGES
    + "SELECT _version, count(*) AS changed_rows, count(*) FILTER (_op = 'insert') AS inserted,"
    " count(*) FILTER (_op = 'update') AS updated, count(*) FILTER (_op = 'delete') AS deleted"
    " FROM changes GROUP BY 1 ORDER BY 1 DESC LIMIT 2",
)
def table_history(spark, sf):
    return merge.history(changes(spark, sf), newest=2).drop("committed_at")


@query(
    "change_feed",
    WITH_CHANGES
    + f", {_as_of_sql(0, 'a')}, {_as_of_sql(2, 'b')} SELECT transaction_id,"
    " CASE WHEN a.transaction_id IS NULL THEN 'insert' WHEN b.transaction_id IS NULL THEN 'delete'"
    " ELSE 'update' END AS _change,"
    " CASE WHEN b.transaction_id IS NULL THEN a.customer_id ELSE b.customer_id END AS customer_id,"
    " CASE WHEN b.transaction_id IS NULL THEN a.total_amount ELSE b.total_amount END AS total_amount,"
    " CASE WHEN b.transaction_id IS NULL THEN a.status ELSE b.status END AS status"
    " FROM a FULL JOIN b USING (transaction_id) WHERE a.customer_id IS DISTINCT FROM b.customer_id"
    " OR a.total_amount IS DISTINCT FROM b.total_amount OR a.status IS DISTINCT FROM b.status",
)
def change_feed(spark, sf):
    return merge.change_feed(changes(spark, sf), _KEYS, 0, 2)


# Checkpoints: one row per event type as pipeline

_HALF_TIME = "2024-01-15"
_CHECKPOINT_SQL = (
    "SELECT event_type AS pipeline_name, 'watermark' AS checkpoint_type,"
    " strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS checkpoint_value FROM events"
)


def _marks(events):
    """Newest event time per type in checkpoint form."""
    return events.groupBy(F.col("event_type").alias("pipeline_name")).agg(
        F.lit("watermark").alias("checkpoint_type"),
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("checkpoint_value"),
    )


def _before_half(spark, sf):
    return table(spark, sf, "events").filter(F.col("ts") < F.to_timestamp_ntz(F.lit(_HALF_TIME)))


@query(
    "checkpoint_state",
    f"SELECT * FROM ({_CHECKPOINT_SQL} WHERE event_type IN ('click', 'view') GROUP BY 1) UNION ALL"
    f" SELECT * FROM ({_CHECKPOINT_SQL} WHERE ts < TIMESTAMP '2024-01-15' AND"
    " event_type NOT IN ('click', 'view') GROUP BY 1)",
)
def checkpoint_state(spark, sf):
    """Two pipelines move their mark; the marks of the others stay."""
    stored = _marks(_before_half(spark, sf))
    moved = table(spark, sf, "events").filter(F.col("event_type").isin("click", "view"))
    return merge.save_checkpoint(stored, _marks(moved))


@query(
    "checkpoint_resume",
    "WITH marks AS (SELECT event_type, max(ts) AS mark FROM events WHERE ts < TIMESTAMP '2024-01-15'"
    " AND event_type <> 'signup' GROUP BY 1)"
    " SELECT event_id, event_type, value FROM events LEFT JOIN marks USING (event_type)"
    " WHERE mark IS NULL OR ts > mark",
)
def checkpoint_resume(spark, sf):
    """Each event type resumes after its own mark; a type without a mark is read whole."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    seen = _before_half(spark, sf).filter("event_type <> 'signup'")
    marks = _marks(seen).select(
        F.col("pipeline_name").alias("event_type"), F.to_timestamp_ntz("checkpoint_value").alias("mark")
    )
    return merge.resume_by_partition(events, marks, "event_type", "ts", "mark").drop("ts")


# Run metrics

_RATES = (
    "CAST(CAST(records_output * 100.0::DOUBLE / records_input AS DECIMAL(5,2)) AS DOUBLE) AS success_rate,"
    " CAST(CAST(records_failed * 100.0::DOUBLE / records_input AS DECIMAL(5,2)) AS DOUBLE) AS failure_rate"
)


@query(
    "quality_trend",
    f"WITH {RUNS_SQL} SELECT CAST(start_time AS VARCHAR) AS start_time, records_input, records_output,"
    f" records_failed, {_RATES} FROM runs",
)
def quality_trend_query(spark, sf):
    return quality_trend(runs(spark, sf)).orderBy("start_time")


@query(
    "quality_alert",
    f"WITH {RUNS_SQL}, trend AS (SELECT start_time, {_RATES} FROM runs)"
    " SELECT CAST(start_time AS VARCHAR) AS start_time, failure_rate, failure_rate > 10 AS is_alert"
    " FROM trend ORDER BY trend.start_time DESC LIMIT 1",
)
def quality_alert_query(spark, sf):
    return quality_alert(quality_trend(runs(spark, sf)))


@query("partition_profile")
def partition_profile_query(spark, sf):
    """How the scan of each given table is dealt out: partitions, rows of the smallest, mean and largest one, skew."""
    profiles = [partition_profile(table(spark, sf, t)).withColumn("table_name", F.lit(t)) for t in TABLES]
    return reduce(DataFrame.unionByName, profiles)


# Files read once, by a ledger of their own


def _publish(df, folder, name):
    """``df`` as files ``name-0``, ``name-1``, ... of ``folder``, replacing files of these names."""
    draft, storage = new_folder(df.sparkSession, "draft"), Storage(df.sparkSession)
    df.write.parquet(draft)
    for k, part in enumerate(n for n in storage.names(draft) if n.startswith("part-")):
        storage.move(f"{draft}/{part}", f"{folder}/{name}-{k}.parquet", replace=True)


@query(
    "ledger_incremental",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN 2 * o_totalprice ELSE o_totalprice END AS o_totalprice,"
    " CASE WHEN o_orderkey % 4 IN (1, 3) THEN 2 ELSE 1 END::BIGINT AS load FROM orders WHERE o_orderkey % 8 <> 5",
)
def ledger_incremental(spark, sf):
    """Two deliveries; the second changes files in place (prices doubled, some orders gone) and adds new ones.

    The second load reads the changed and the new files alone, a third one finds nothing.
    """
    orders, folder = table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), new_folder(spark, "inbox")
    ledger = FileLedger(spark, folder, new_folder(spark, "ledger"))

    def group(k):
        return orders.filter(F.col("o_orderkey") % 4 == k).repartition(2, "o_orderkey")

    def load():
        return ledger.load(lambda paths: spark.read.schema(orders.schema).parquet(*paths))

    for k in (0, 1, 2):
        _publish(group(k), folder, f"orders-{k}")
    first = load()
    _publish(group(1).filter("o_orderkey % 8 <> 5").withColumn("o_totalprice", 2 * F.col("o_totalprice")), folder, "orders-1")
    _publish(group(3), folder, "orders-3")
    if (first, load(), load()) != (6, 4, 0):
        raise RuntimeError("a load takes the files that are new or changed, and no others")
    return ledger.rows().select("o_orderkey", "o_totalprice", "load")
