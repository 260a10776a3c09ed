"""Marketing campaign ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import percent, ratio


def campaign_metrics(df: DataFrame) -> DataFrame:
    """Click-through and conversion rate in percent, and return on spend; NULL without a base."""
    return df.withColumns(
        {
            "ctr": F.round(percent("clicks", "impressions"), 2),
            "conversion_rate": F.round(percent("conversions", "clicks"), 2),
            "roas": F.round(ratio("revenue", "budget"), 2),
        }
    )


def campaign_totals(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.sum(F.col("budget").cast("decimal(28,2)")).alias("total_budget"),
        F.sum(F.col("revenue").cast("decimal(28,2)")).alias("total_revenue"),
        F.round(F.avg("roas"), 6).alias("avg_roas"),
        F.sum("conversions").alias("total_conversions"),
    )
