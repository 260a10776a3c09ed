"""JSON text, maps and nested arrays to flat rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from .joins import join_null_safe

CORRUPT = "_rescued_data"


def parse_json(df: DataFrame, column: str, schema: str, keep: list[str] = ()) -> DataFrame:
    """Permissive parse: a field that does not fit becomes NULL, the row stays."""
    parsed = df.select(*keep, F.from_json(column, schema).alias("__p"))
    return parsed.select(*keep, "__p.*")


def parse_json_or_fail(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Fail at run time on the first malformed text."""
    return df.select(F.from_json(column, schema, {"mode": "FAILFAST"}).alias("__p")).select("__p.*")


def parse_json_with_rescue(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Permissive parse that keeps the raw text of malformed rows in ``_rescued_data``."""
    options = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = df.select(F.from_json(column, f"{schema}, {CORRUPT} string", options).alias("__p"))
    return parsed.select("__p.*")


def parse_json_or_stop(df: DataFrame, column: str, schema: str) -> DataFrame:
    """As :func:`parse_json_or_fail`, with an error that shows the malformed text (see :func:`offending_text`)."""
    rescued = parse_json_with_rescue(df, column, schema)
    fields = [c for c in rescued.columns if c != CORRUPT]
    stop = F.when(F.col(CORRUPT).isNotNull(), F.raise_error(F.concat(F.lit(OFFENDING), CORRUPT)).cast("boolean")).otherwise(True)
    return rescued.filter(stop).select(*fields)


#: Stands before the malformed text in the error.
OFFENDING = "malformed text: "


def offending_text(error: Exception) -> str | None:
    """The text that stopped :func:`parse_json_or_stop`; None for other errors."""
    found = re.search(re.escape(OFFENDING) + r"(.*?)(?: SQLSTATE: P0001)?$", str(error), re.MULTILINE)
    return found and found[1]


def split_rescued(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed rows with their raw text)."""
    rescued = F.col(CORRUPT).isNotNull()
    return parsed.filter(~rescued).drop(CORRUPT), parsed.filter(rescued)


def drop_malformed(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Rows whose text fits the schema; a missing field is NULL and stays."""
    return split_rescued(parse_json_with_rescue(df, column, schema))[0]


def drop_incomplete(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Rows in which every field was read; missing fields drop the row, too."""
    return parse_json(df, column, schema).na.drop()


def flatten_envelope(
    responses: DataFrame, rows: str, stamp: str, source_api: str, keep: list[str] = ()
) -> DataFrame:
    """Rows of API responses with the response time and the name of the API."""
    exploded = responses.select(*keep, F.col(stamp).alias("__at"), F.explode(rows).alias("__r"))
    return exploded.select(
        *keep,
        "__r.*",
        F.try_to_timestamp("__at").alias("api_timestamp"),
        F.lit(source_api).alias("source_api"),
    )


def pages_until_empty(pages: DataFrame, page_no: str, rows: str, group: list[str] = ()) -> DataFrame:
    """Rows of all pages before the first empty page (of each group).

    The position of the first empty page is a small aggregate; the rows are exploded where
    they lie, without a shuffle by page.
    """
    is_empty = F.coalesce(F.size(rows) == 0, F.lit(True))
    body = pages.select(*group, page_no, F.explode(rows).alias("__r"))
    if group:
        ends = pages.groupBy(*group).agg(F.min(F.when(is_empty, F.col(page_no))).alias("__end"))
        body = join_null_safe(body, ends, list(group))
        end: Column = F.col("__end")
    else:
        end = pages.agg(F.min(F.when(is_empty, F.col(page_no)))).scalar()
    return body.filter(end.isNull() | (F.col(page_no) < end)).select(*group, page_no, "__r.*")


def flatten_attribute(df: DataFrame, attributes: str, key: str) -> DataFrame:
    """Lift one map entry to a column and keep the map as ``extra_info``."""
    return df.withColumn(key, F.try_element_at(attributes, F.lit(key))).withColumnRenamed(
        attributes, "extra_info"
    )


def numbered_items(df: DataFrame, keep: list[str], items: str = "items", page: str = "page_no", page_rows: int = 1000) -> DataFrame:
    """Items of paged lists, one row each, with ``item_no`` counting from 1 over all pages of a list."""
    each = df.select(*keep, F.col(page).alias("__page"), F.posexplode(items).alias("__pos", "__item"))
    number = (F.col("__page") * page_rows + F.col("__pos") + 1).cast("long")
    return each.select(*keep, number.alias("item_no"), "__item.*")


def explode_items(orders: DataFrame, items: str = "items", keep: list[str] = ()) -> DataFrame:
    """One row per item with ``quantity * unit_price * (1 - discount)`` as line total."""
    rows = orders.select(*keep, F.explode(items).alias("i")).select(*keep, "i.*")
    total = F.col("quantity") * F.col("unit_price") * (F.lit(1.0) - F.col("discount"))
    return rows.withColumn("line_total", total)
