"""Registered queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; without ``oracle`` only its rows are checked."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(function(spark, sf_dir))

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def presentable(df: DataFrame) -> DataFrame:
    """Result types that look alike in every client: dates as ISO text, decimals as doubles."""

    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])
