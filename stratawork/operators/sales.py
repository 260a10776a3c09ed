"""Projections, aggregates and rankings over sales-like tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import amount_band, price_after_discount, price_tier
from ..functions.numbers import from_units, money_mean, money_sum, ratio, units
from ..workspace import durable
from .joins import DEFAULT_BROADCAST_BYTES, measured_bytes


def enhance(df: DataFrame) -> DataFrame:
    """Line total from quantity and price, and what is left after an optional discount."""
    full = F.col("quantity") * F.col("unit_price")
    return df.withColumns(
        {"line_total": full, "discounted_amount": price_after_discount(full, "discount_amount")}
    )


def tax_and_tier(df: DataFrame, amount: str = "total_amount", rate: float = 0.1) -> DataFrame:
    return df.select("*", (F.col(amount) * rate).alias("tax"), price_tier(amount).alias("tier"))


def band(df: DataFrame, amount: str = "total_amount") -> DataFrame:
    return df.withColumn("amount_category", amount_band(amount))


def scale_column(df: DataFrame, column: str, factor: float) -> DataFrame:
    return df.withColumn(column, F.col(column) * factor)


def transition(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """Rewrite one status value, leave the others."""
    return df.withColumn(column, F.when(F.col(column) == old, new).otherwise(F.col(column)))


def summarize(df: DataFrame, keys: list, amount: str = "total_amount") -> DataFrame:
    """Count, sum, mean, largest and smallest amount per group."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("transaction_count"),
        money_sum(amount).alias("total_revenue"),
        money_mean(amount).alias("avg_transaction"),
        F.max(amount).alias("max_transaction"),
        F.min(amount).alias("min_transaction"),
    )


def fold(df: DataFrame, keys: list[str], amount: str = "total_amount") -> DataFrame:
    """Mergeable partial summary per join key, to be joined and passed to :func:`unfold`.

    Folding before a join keeps a key that holds a third of all rows out of the shuffle.
    """
    return df.groupBy(*keys).agg(
        F.count("*").alias("__count"),
        F.count(amount).alias("__known"),
        F.sum(units(amount)).alias("__units"),
        F.max(amount).alias("__max"),
        F.min(amount).alias("__min"),
    )


def unfold(partial: DataFrame, keys: list[str]) -> DataFrame:
    """The result of :func:`summarize` from rows of :func:`fold`."""
    total = from_units(F.sum("__units"))
    return partial.groupBy(*keys).agg(
        F.sum("__count").alias("transaction_count"),
        total.alias("total_revenue"),
        ratio(total, F.sum("__known")).alias("avg_transaction"),
        F.max("__max").alias("max_transaction"),
        F.min("__min").alias("min_transaction"),
    )


def refold(partial: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of :func:`fold` under coarser keys, still mergeable."""
    return partial.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("__count", "__known", "__units")],
        F.max("__max").alias("__max"),
        F.min("__min").alias("__min"),
    )


def unfold_revenue(partial: DataFrame, keys: list[str], name: str = "revenue", count: str = "transactions") -> DataFrame:
    """The result of :func:`revenue` from rows of :func:`fold`."""
    return partial.groupBy(*keys).agg(from_units(F.sum("__units")).alias(name), F.sum("__count").alias(count))


def _beside_small(facts: DataFrame, dimensions: dict[str, DataFrame], max_bytes: int) -> DataFrame | None:
    """Facts joined to dimensions by their keys, where all of these measure small enough to be broadcast."""
    if any(measured_bytes(d) > max_bytes for d in dimensions.values()):
        return None
    for key, dimension in dimensions.items():
        facts = facts.join(F.broadcast(dimension), key)
    return facts


def _folded_beside(facts: DataFrame, dimensions: dict[str, DataFrame], keys: list[str], amount: str) -> DataFrame:
    """Facts folded per dimension key and joined one dimension after the other."""
    own = [k for k in keys if k in facts.columns and k not in dimensions]
    partial = fold(facts, [*dimensions, *own], amount)
    for key, dimension in dimensions.items():
        partial = partial.join(dimension, key)
    return partial


def summarize_by(
    facts: DataFrame,
    dimensions: dict[str, DataFrame],
    keys: list[str],
    amount: str = "total_amount",
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """:func:`summarize` by columns of which some come from ``dimensions`` (join key to rows).

    Dimensions that measure small are broadcast, and the facts meet no shuffle before they are folded to the
    groups asked for. Otherwise facts fold per join key first, which keeps a hot key out of the shuffle
    of the join; where nearly every fact is a group of its own that only adds work, hence the measurement.
    """
    joined = _beside_small(facts, dimensions, max_bytes)
    if joined is not None:
        return summarize(joined, keys, amount)
    return unfold(_folded_beside(facts, dimensions, keys, amount), keys)


def revenue_by(
    facts: DataFrame,
    dimensions: dict[str, DataFrame],
    keys: list[str],
    amount: str = "total_amount",
    name: str = "revenue",
    count: str = "transactions",
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """:func:`revenue` by columns of which some come from ``dimensions``, as in :func:`summarize_by`."""
    joined = _beside_small(facts, dimensions, max_bytes)
    if joined is not None:
        return joined.groupBy(*keys).agg(money_sum(amount).alias(name), F.count("*").alias(count))
    return unfold_revenue(_folded_beside(facts, dimensions, keys, amount), keys, name, count)


def revenue(df: DataFrame, keys: list, amount: str = "total_amount", name: str = "revenue") -> DataFrame:
    return df.groupBy(*keys).agg(
        money_sum(amount).alias(name), F.count("*").alias("transactions")
    )


def share_of_total(grouped: DataFrame, amount: str, name: str) -> DataFrame:
    """Percentage of the grand total.

    The grouped rows are written once, so that neither the total nor the shares repeat the work
    behind them. A window without partitions would pull every group into one task instead.
    """
    kept = durable(grouped, "grouped")
    total = kept.agg(F.sum(amount).cast("double")).scalar()
    return kept.withColumn(name, F.try_divide(F.col(amount).cast("double") * 100.0, total))


def lifetime(df: DataFrame, key: str = "customer_id", amount: str = "total_amount") -> DataFrame:
    """Running state of each customer."""
    return df.groupBy(key).agg(
        money_sum(amount).alias("lifetime_value"),
        F.count("*").alias("total_transactions"),
        F.max("transaction_date").alias("last_transaction"),
        money_mean(amount).alias("avg_transaction_amount"),
    )


def weekly(df: DataFrame, ts: str, key: str, amount: str = "total_amount") -> DataFrame:
    """Tumbling seven-day windows per key."""
    grouped = df.groupBy(F.window(ts, "7 days").alias("w"), key)
    return grouped.agg(
        money_sum(amount).alias("weekly_revenue"), F.count("*").alias("weekly_transactions")
    ).select(F.col("w.start").alias("week_start"), key, "weekly_revenue", "weekly_transactions")


