"""Banding rules as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import col_of

# Thresholds and labels of the published banding rules.
AMOUNT_BANDS = [(50, "Low"), (200, "Medium")]
AMOUNT_TOP = "High"
TIER_LIMIT = 200
PERFORMANCE_TIERS = [(50, "High Performer"), (20, "Good Performer"), (0, "Positive")]
PERFORMANCE_REST = "Negative"
RISK_LOW = 1.0
RISK_HIGH = 2.0


def amount_band(amount: str | Column) -> Column:
    """Low below 50, Medium below 200, else High; a missing amount has no band."""
    value = col_of(amount)
    bands = F.when(value.isNull(), F.lit(None).cast("string"))
    for limit, label in AMOUNT_BANDS:
        bands = bands.when(value < limit, label)
    return bands.otherwise(AMOUNT_TOP)


def price_tier(amount: str | Column) -> Column:
    return F.when(col_of(amount) > TIER_LIMIT, "premium").otherwise("standard")


def performance_tier(total_return: str | Column) -> Column:
    value = col_of(total_return)
    first_limit, first_label = PERFORMANCE_TIERS[0]
    tiers = F.when(value > first_limit, first_label)
    for limit, label in PERFORMANCE_TIERS[1:]:
        tiers = tiers.when(value > limit, label)
    return tiers.otherwise(PERFORMANCE_REST)


def risk_level(volatility: str | Column) -> Column:
    """Low under 1, Medium from 1 to 2, High above; NULL when there is no volatility."""
    value = col_of(volatility)
    return (
        F.when(value < RISK_LOW, "Low")
        .when(value <= RISK_HIGH, "Medium")
        .when(value > RISK_HIGH, "High")
    )


def price_after_discount(amount: str | Column, discount: str | Column) -> Column:
    """Amount less discount; a missing discount means the full amount."""
    return col_of(amount) - F.coalesce(col_of(discount), F.lit(0.0))


def loyalty_score(amount: str | Column) -> Column:
    """One point per ten units of money, at most 100 (``float``)."""
    value = col_of(amount)
    return F.when(value.isNotNull(), F.least(F.lit(100.0), value / 10.0)).cast("float")
