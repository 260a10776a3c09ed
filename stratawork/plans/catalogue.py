"""Imports every query module, which registers its queries."""

from . import finance, incremental, ingestion, quality, relational, tables  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
