"""Cleansing: duplicates, string forms, missing values, typed casts of dirty text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import top_rows
from .quality import validate_data_quality

# Fixed value: what counts as a plain unsigned number in dirty text.
NUMERIC_TEXT = r"^[0-9]*\.?[0-9]+$"


def remove_duplicates(
    df: DataFrame,
    subset: list[str] | None = None,
    keep: str = "first",
    order_by: list[str] | None = None,
) -> DataFrame:
    """One row per key.

    With ``order_by`` the first (or last) row in that order stays, so the result does not
    depend on scheduling; without it any copy may stay. Both ways thin out copies before the
    shuffle, so a key copied a billion times costs one row per map task.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    if not order_by:
        return df.dropDuplicates(subset) if subset else df.dropDuplicates()
    keys = subset or df.columns
    order = [c if keep == "first" else f"-{c}" for c in order_by]
    return top_rows(df, keys, order, 1, "__copy").drop("__copy")


def standardize_string_columns(
    df: DataFrame, columns: list[str], case: str = "upper", trim_spaces: bool = True
) -> DataFrame:
    """Trim and change the case of the named columns in one projection."""
    changes = {"upper": F.upper, "lower": F.lower, "none": lambda c: c}
    if case not in changes:
        raise ValueError(f"case must be one of {sorted(changes)}, not {case!r}")

    def tidy(name: str) -> Column:
        column = F.trim(F.col(name)) if trim_spaces else F.col(name)
        return changes[case](column)

    return df.withColumns({name: tidy(name) for name in columns})


def fill_missing_values(
    df: DataFrame, column: str, fill_value=None, fill_with_column: str | None = None
) -> DataFrame:
    """Replace NULL by another column or by a constant; the column is preferred."""
    if fill_with_column:
        substitute = F.col(fill_with_column)
    elif fill_value is not None:
        substitute = F.lit(fill_value)
    else:
        return df
    return df.withColumn(column, F.coalesce(F.col(column), substitute))


def numeric_or_null(text: str) -> Column:
    """Double value of plain numeric text, NULL for anything else."""
    return F.when(F.col(text).rlike(NUMERIC_TEXT), F.col(text).try_cast("double"))


def clean_orders(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Typed, validated, de-duplicated orders from an all-text layer.

    Expects order_id, customer_email, product, amount, order_date and status as text; further
    columns pass through. ``is_valid`` is true for a readable id with a positive amount and is never
    NULL. Rows without a readable id cannot be copies of each other: they all stay, as invalid.
    """
    amount = numeric_or_null("amount")
    typed = raw.withColumns(
        {
            "order_id": F.col("order_id").try_cast("bigint"),
            "customer_email": F.trim(F.upper("customer_email")),
            "amount": amount,
            "order_date": F.try_to_timestamp("order_date"),
            "is_valid": F.coalesce(amount > 0, F.lit(False)),
        }
    )
    known, unknown = typed.filter("order_id is not null"), typed.filter("order_id is null")
    known = remove_duplicates(known, ["order_id"], order_by=order_by)
    return known.unionByName(unknown.withColumn("is_valid", F.lit(False)))


def clean_sales(df: DataFrame) -> DataFrame:
    """Rows with positive quantity and amount; store location trimmed and upper case."""
    kept = df.filter((F.col("quantity") > 0) & (F.col("total_amount") > 0))
    return standardize_string_columns(kept, ["store_location"])


def clean_customers(
    df: DataFrame,
    *,
    key: str = "customer_id",
    upper: list[str],
    fills: dict[str, object],
    required: list[str],
    order_by: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """De-duplicate, standardise, fill and split customers into (good, bad)."""
    flow = standardize_string_columns(remove_duplicates(df, [key], order_by=order_by), upper)
    flow = flow.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})
    return validate_data_quality(flow, required, required)
