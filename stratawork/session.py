"""Session settings the library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "stratawork", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC time, ANSI errors and adaptive execution.

    The shuffle partition count stays with the cluster: adaptive execution merges small
    partitions, splits skewed join partitions and turns a sort-merge join into a broadcast
    join once the measured side is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # An extra shuffle is cheaper than one task that holds a third of all rows.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
