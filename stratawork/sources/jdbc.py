"""Relational sources over JDBC, read in parallel ranges of a numeric or date column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str,
    table: str,
    *,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    fetch_rows: int = 10_000,
    properties: dict | None = None,
) -> dict:
    """Reader options; a partition column needs bounds, as Spark cuts the range into tasks."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **(properties or {})}
    if driver:
        options["driver"] = driver
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs (lower, upper) bounds")
        lower, upper = bounds
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    """Table or ``(query) alias``; filters and column selections are pushed to the database."""
    return spark.read.format("jdbc").options(**read_options(url, table, **settings)).load()
