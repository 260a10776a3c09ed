"""Run metrics, quality trend, partition profile and timing."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.numbers import percent

RUN_SCHEMA = (
    "run_id string, pipeline_name string, start_time timestamp, end_time timestamp, status string,"
    " records_input long, records_output long, records_failed long, error_message string"
)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without another pass."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def run_record(
    spark: SparkSession,
    run_id: str,
    name: str,
    started: datetime,
    *,
    records_input: int | None = None,
    records_output: int | None = None,
    records_failed: int | None = None,
    status: str = "SUCCESS",
    error_message: str | None = None,
    ended: datetime | None = None,
) -> DataFrame:
    """One row of run metrics, to be appended to the metrics table."""
    ended = ended or datetime.now(timezone.utc)
    row = (run_id, name, started, ended, status, records_input, records_output, records_failed, error_message)
    return spark.createDataFrame([row], RUN_SCHEMA)


def quality_trend(runs: DataFrame) -> DataFrame:
    """Success and failure rate of each run as ``decimal(5,2)``."""
    rates = {
        "success_rate": percent("records_output", "records_input").cast("decimal(5,2)"),
        "failure_rate": percent("records_failed", "records_input").cast("decimal(5,2)"),
    }
    return runs.withColumns(rates).select(
        "start_time", "records_input", "records_output", "records_failed", *rates
    )


def quality_alert(trend: DataFrame, threshold: float = 10.0) -> DataFrame:
    """The latest run and whether its failure rate is above the threshold."""
    latest = trend.orderBy(F.desc("start_time")).limit(1)
    over = F.coalesce(F.col("failure_rate") > threshold, F.lit(False))
    return latest.select("start_time", "failure_rate", over.alias("is_alert"))


def partition_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("row_count"))


def partition_profile(df: DataFrame, skew_limit: float = 2.0) -> DataFrame:
    """Partition count, row spread and skew (largest over mean) of a frame as it stands."""
    spread = partition_sizes(df).agg(
        F.count("*").alias("partition_count"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.avg("row_count").alias("avg_rows"),
        F.min("row_count").alias("min_rows"),
        F.max("row_count").alias("max_rows"),
    )
    skew = F.try_divide(F.col("max_rows"), F.col("avg_rows"))
    return spread.withColumns(
        {"skew_ratio": skew, "is_skewed": F.coalesce(skew > skew_limit, F.lit(False))}
    )


def monitor_query_performance(df: DataFrame, operation_name: str) -> dict:
    """Seconds and rows per second of running a frame into a sink that discards rows."""
    watched, observation = counted(df, operation_name)
    begin = time.perf_counter()
    watched.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - begin
    rows = observation.get["rows"]
    return {
        "operation": operation_name,
        "execution_time": round(seconds, 3),
        "rows_processed": rows,
        "rows_per_second": round(rows / seconds, 2) if seconds > 0 else 0,
    }
