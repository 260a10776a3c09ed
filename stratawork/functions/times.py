"""Timestamp conversions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import col_of


def instant_from_utc(naive: str | Column) -> Column:
    """Zone-less UTC time as an instant, whatever the session time zone is.

    Watermarks need instants; the stored tables hold zone-less times.
    """
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), col_of(naive))
    return local.cast("timestamp")


def utc_from_instant(instant: str | Column) -> Column:
    """Inverse of :func:`instant_from_utc`."""
    local = col_of(instant).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
