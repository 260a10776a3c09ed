"""Raw to cleaned to aggregated tables, each layer written before the next one reads it."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..catalog import save_files
from ..operators.campaigns import campaign_metrics, campaign_totals
from ..operators.cleanse import clean_orders
from ..operators.profile import counted, run_record
from ..operators.quality import route_by_status, split_rows, with_quality_score
from ..operators.sales import revenue
from ..sources.files import with_lineage
from ..workspace import new_folder, reused


class LayerFolders:
    """The three layers of one run below a shared folder; usable without a metastore."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base = spark, new_folder(spark, label)

    def write(self, df: DataFrame, layer: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write one layer and return it as read back: a restart point for the next layer."""
        save_files(df, f"{self.base}/{layer}", partition_by=partition_by)
        return self.read(layer)

    def read(self, layer: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{layer}")


def daily_store_revenue(raw_sales: DataFrame, layers: LayerFolders) -> DataFrame:
    """Raw sales to positive quantities to revenue per day and store."""
    bronze = layers.write(with_lineage(raw_sales, source_system="store_files"), "bronze")
    positive = bronze.filter("quantity > 0").withColumn("store_location", F.upper("store_location"))
    silver = layers.write(positive, "silver")
    daily = revenue(silver, [F.to_date("transaction_date").alias("date"), "store_location"])
    return layers.write(daily, "gold")


def daily_completed_orders(raw: DataFrame, layers: LayerFolders, gold_of, order_by: list[str]) -> DataFrame:
    """All-text orders to typed, de-duplicated orders to completed orders per day."""
    bronze = layers.write(with_lineage(raw, source_system="order_service"), "bronze")
    silver = layers.write(clean_orders(bronze, order_by=order_by), "silver")
    return layers.write(gold_of(silver), "gold")


def campaign_performance(raw: DataFrame, layers: LayerFolders) -> DataFrame:
    """Campaign counters to ratios to one line of totals."""
    bronze = layers.write(with_lineage(raw, source_api="campaigns_api"), "bronze")
    silver = layers.write(campaign_metrics(bronze), "silver")
    return layers.write(campaign_totals(silver), "gold")


def customer_quality(raw: DataFrame, layers: LayerFolders, checks: dict[str, Column]) -> DataFrame:
    """Score customers, keep the good and the flagged, quarantine the failed; returns the run record.

    The scored rows are worked out once, for the count and for both routes. What each route gets is observed
    while it is written, without further passes.
    """
    started = datetime.now(timezone.utc)
    with reused(with_quality_score(raw, checks)) as scored:
        records_input = scored.count()
        kept_rows, failed_rows = route_by_status(scored)
        kept, failed = written_counts(layers, {"silver": kept_rows, "quarantine": failed_rows})
    return run_record(
        layers.spark,
        str(uuid.uuid4()),
        "customer_quality",
        started,
        records_input=records_input,
        records_output=kept,
        records_failed=failed,
    )


def written_counts(layers: LayerFolders, parts: dict[str, DataFrame]) -> list[int]:
    """Write each part to the layer of its name; the rows of each, as observed by its write."""
    counts = []
    for layer, rows in parts.items():
        watched, seen = counted(rows, layer)
        layers.write(watched, layer)
        counts.append(seen.get["rows"])
    return counts


def quarantine(raw: DataFrame, layers: LayerFolders, condition: Column) -> DataFrame:
    """Land accepted and quarantined rows from one evaluation of ``raw``; both are returned, marked by ``route``."""
    with reused(raw) as rows:
        good, bad = split_rows(rows, condition)
        written_counts(layers, {"accepted": good, "quarantined": bad})
    landed = [layers.read(layer).withColumn("route", F.lit(layer)) for layer in ("accepted", "quarantined")]
    return landed[0].unionByName(landed[1])
