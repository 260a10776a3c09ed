"""Small in-memory rows to DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, types as T


def from_rows(spark: SparkSession, rows: Sequence, schema: T.StructType | str | list[str] | None = None) -> DataFrame:
    """Tuples, dicts or ``Row`` objects. A full schema is enforced (types and NULLs); names alone,
    or nothing, leave the types to inference."""
    return spark.createDataFrame(rows, schema)


def from_pandas(spark: SparkSession, frame: pd.DataFrame, schema: T.StructType | str) -> DataFrame:
    """Arrow transfer of a small pandas frame, columns taken by name in schema order."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return spark.createDataFrame(frame[schema.names], schema)
