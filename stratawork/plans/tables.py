"""Layered catalog tables, path writes, bounded hand-offs and physical layouts, each read back."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, functions as F

from ..catalog import Layers, bounded_to_pandas, ingest_csv_with_schema, save_files
from ..operators.profile import monitor_query_performance
from ..operators.quality import validate_data_quality
from ..operators.sales import revenue
from ..sources.rows import from_pandas
from ..workspace import durable, new_folder
from .registry import query
from .relational import WITH_SALES
from .views import sales, table


@contextmanager
def _own_layers(spark):
    """Layers in a schema of their own, which goes at the end with its tables."""
    layers = Layers.for_email(spark, f"stratawork.{uuid.uuid4().hex}@example.com")
    try:
        yield layers
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {layers.get_schema_path()} CASCADE")


@query("csv_to_raw_table", "SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_suppkey % 3 <> 0")
def csv_to_raw_table(spark, sf):
    """Two CSV deliveries under a declared schema; the second overwrites the raw table, which is then read by its name."""
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    with _own_layers(spark) as layers:
        for rows in (suppliers, suppliers.filter("s_suppkey % 3 <> 0")):
            path = new_folder(spark, "suppliers-csv")
            save_files(rows, path, "csv")
            ingest_csv_with_schema(layers, path, suppliers.schema, "suppliers")
        return durable(layers.table("bronze", "suppliers"), "raw-table")


@query(
    "layer_tables",
    "SELECT 'bronze_lines' AS table_name, count(*) AS record_count FROM lineitem"
    " UNION ALL SELECT 'gold_flags', count(DISTINCT l_returnflag) FROM lineitem"
    " UNION ALL SELECT 'silver_lines', count(*) FROM lineitem WHERE l_quantity > 25",
)
def layer_tables(spark, sf):
    """One table in each layer of a new schema, each made from the table of the layer below; their inventory."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    with _own_layers(spark) as layers:
        raw = layers.write(lines, "bronze", "lines")
        clean = layers.write(raw.filter("l_quantity > 25"), "silver", "lines")
        layers.write(raw.join(clean.select("l_returnflag").distinct(), "l_returnflag", "left").groupBy("l_returnflag").count(), "gold", "flags")
        return durable(layers.inventory(), "inventory")


@query("text_lines_written", "SELECT o_orderpriority || ' ' || o_orderkey AS line, o_totalprice FROM orders")
def text_lines_written(spark, sf):
    """The same rows as text lines and as columnar files below two paths; the lines are matched to the rows again."""
    orders, text, columns = table(spark, sf, "orders"), new_folder(spark, "lines"), new_folder(spark, "columns")
    line = F.concat_ws(" ", "o_orderpriority", "o_orderkey").alias("line")
    save_files(orders.select(line), text, "text")
    save_files(orders.select(line, "o_totalprice"), columns)
    return spark.read.text(text).withColumnRenamed("value", "line").join(spark.read.parquet(columns), "line")


@query(
    "bounded_hand_off",
    "SELECT o_orderpriority AS priority, count(*) AS orders, max(o_totalprice) AS largest FROM orders GROUP BY 1",
)
def bounded_hand_off(spark, sf):
    """Aggregated on the cluster, handed to pandas behind a row limit, and taken back under a declared schema."""
    orders = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority"))
    frame = bounded_to_pandas(orders.agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("largest")), 1000)
    return from_pandas(spark, frame, "priority string, orders long, largest double")


@query(
    "required_columns_only",
    "SELECT 'good' AS side, count(*) AS rows FROM customer UNION ALL SELECT 'quarantined', 0",
)
def required_columns_only(spark, sf):
    """Without columns that must be filled, the other side is an empty frame of the same schema."""
    good, other = validate_data_quality(table(spark, sf, "customer"), ["c_custkey", "c_name"])
    sides = [df.agg(F.lit(name).alias("side"), F.count("*").alias("rows")) for name, df in (("good", good), ("quarantined", other))]
    return sides[0].unionByName(sides[1])


@query("monitored_rows", "SELECT 'price scan' AS operation, count(*) AS rows_processed, true AS is_timed FROM lineitem WHERE l_discount > 0.02")
def monitored_rows(spark, sf):
    """A frame run into a sink that keeps nothing: rows as observed on the way, and the time it took."""
    seen = monitor_query_performance(table(spark, sf, "lineitem").filter("l_discount > 0.02"), "price scan")
    timed = seen["execution_time"] > 0 and seen["rows_per_second"] > 0 or seen["rows_processed"] == 0
    return spark.createDataFrame(
        [(seen["operation"], seen["rows_processed"], timed)], "operation string, rows_processed long, is_timed boolean"
    )


_SUM_SQL = (
    WITH_SALES
    + "SELECT product_category, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS transactions FROM sales GROUP BY 1"
)


def _sum_by_category(lines: DataFrame) -> DataFrame:
    return revenue(lines, ["product_category"])


@query("sum_by_category_repartitioned", _SUM_SQL)
def sum_by_category_repartitioned(spark, sf):
    """Lines dealt out by their line as well, so that a hot category does not land in one task."""
    lines = sales(spark, sf, "product_category", "total_amount", "transaction_id", "line_number")
    return _sum_by_category(lines.repartition(8, "product_category", "transaction_id", "line_number"))


@query("sum_by_category_coalesced", _SUM_SQL)
def sum_by_category_coalesced(spark, sf):
    """Fewer partitions without a shuffle; only for inputs of many small ones."""
    lines = sales(spark, sf, "product_category", "total_amount")
    return _sum_by_category(lines.coalesce(max(1, lines.rdd.getNumPartitions() // 2)))
