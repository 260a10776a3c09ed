"""Arithmetic that does not raise on a zero divisor and does not depend on row order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def col_of(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


#: Decimals that sums of amounts keep unless told otherwise.
SCALE = 6
#: Larger amounts have no exact form in units of 10^-SCALE.
_LARGEST = 2.0**63


def units(value: str | Column, scale: int = SCALE, name: str | None = None) -> Column:
    """A floating-point amount as a whole number of 10^-``scale``, ``decimal(20,0)``.

    Sums of decimals are exact, so the order in which partial sums meet (which changes when a
    task is retried elsewhere) cannot change the result. Scaling to a whole number first is
    several times faster than casting a double to a scaled decimal, which goes through text.

    No amount is rounded: one with more decimals, a NaN, and one too large for ``scale`` stops the
    job with its value and ``name``.
    """
    name = name or (value if isinstance(value, str) else "amount")
    number = col_of(value).cast("double")
    scaled = number * float(10**scale)
    whole = F.rint(scaled)
    # a double of d decimals times 10^d misses a whole number by its own rounding at most
    close = F.abs(scaled - whole) <= F.lit(1e-6) + F.abs(scaled) * 2.0**-51
    fits = close & (F.abs(scaled) < _LARGEST)
    text = F.concat(F.lit(f"{name}: "), number.cast("string"), F.lit(f" does not fit {scale} decimals"))
    return F.when(fits, whole.cast("bigint")).when(number.isNotNull(), F.raise_error(text).cast("bigint")).cast("decimal(20,0)")


def from_units(total: str | Column, scale: int = SCALE) -> Column:
    """Sum of :func:`units` back in units of money, ``decimal(38,scale)``."""
    return (col_of(total).cast(f"decimal({38 - scale},0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")


def money_sum(value: str | Column, scale: int = SCALE) -> Column:
    """Exact sum of floating-point amounts of at most ``scale`` decimals."""
    return from_units(F.sum(units(value, scale)), scale)


def money_mean(value: str | Column, scale: int = SCALE) -> Column:
    """Mean as exact sum over count; NULL for a group without values."""
    return ratio(money_sum(value, scale), F.count(col_of(value)))


def ratio(part: str | Column, whole: str | Column) -> Column:
    """``part / whole`` as a double, NULL where ``whole`` is zero or NULL."""
    return F.try_divide(col_of(part).cast("double"), col_of(whole).cast("double"))


def percent(part: str | Column, whole: str | Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def percent_change(new: str | Column, old: str | Column) -> Column:
    """Relative change from ``old`` to ``new`` in percent."""
    return percent(col_of(new) - col_of(old), old)
