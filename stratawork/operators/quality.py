"""Row checks, scoring, routing and profiling of data quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Labels and patterns of the published checks.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PASS = "PASS"
AGE_LIMITS = (0, 120)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def is_true(condition: Column) -> Column:
    """Two-valued form of a condition: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def split_rows(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined); every row is in exactly one, unknown goes to quarantine."""
    verdict = is_true(condition)
    return df.filter(verdict), df.filter(~verdict)


def sale_is_valid() -> Column:
    return F.col("customer_id").isNotNull() & (F.col("quantity") > 0) & (F.col("total_amount") > 0)


def validate_data_quality(
    df: DataFrame, required_columns: list[str], non_null_columns: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Raise ``ValueError`` for absent columns, then split on NULLs."""
    absent = [c for c in required_columns if c not in df.columns]
    if absent:
        raise ValueError(f"Missing required columns: {sorted(absent)}")
    if not non_null_columns:
        return df, df.filter(F.lit(False))
    return split_rows(df, all_of([F.col(c).isNotNull() for c in non_null_columns]))


def completeness(required: list[str]) -> Column:
    """Label of the first missing column, else PASS."""
    failing = [F.when(F.col(c).isNull(), f"FAIL: {c} is null") for c in required]
    return F.coalesce(*failing, F.lit(PASS))


def accuracy(age: str = "age", value: str = "lifetime_value") -> Column:
    """Age and value ranges; out of range fails, a zero value warns."""
    low, high = AGE_LIMITS
    return (
        F.when(~F.col(age).between(low, high), f"FAIL: age out of valid range ({low}-{high})")
        .when(F.col(value) < 0, "FAIL: negative lifetime value")
        .when(F.col(value) == 0, "WARN: zero lifetime value")
        .otherwise(PASS)
    )


def consistency(email: str = "email") -> Column:
    matches = F.col(email).rlike(EMAIL_PATTERN)
    return F.when(~matches, "FAIL: invalid email format").otherwise(PASS)


def with_quality_score(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Add one column per check, their joined complaints and the overall status."""
    checked = df.withColumns(checks)
    complaints = [F.when(F.col(name) != PASS, F.col(name)) for name in checks]
    scored = checked.withColumn("quality_issues", F.concat_ws("; ", *complaints))
    status = (
        F.when(F.col("quality_issues").contains("FAIL"), "FAILED")
        .when(F.col("quality_issues").contains("WARN"), "WARNING")
        .otherwise("PASSED")
    )
    return scored.withColumn("quality_status", status)


def customer_checks() -> dict[str, Column]:
    return {
        "completeness_check": completeness(["customer_id", "name", "email"]),
        "accuracy_check": accuracy(),
        "consistency_check": consistency(),
    }


def route_by_status(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined): passed and flagged warnings are kept, failures are not."""
    return split_rows(scored, F.col("quality_status") != "FAILED")


def status_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("quality_status").agg(F.count("*").alias("record_count"))


def null_profile(df: DataFrame, count_nan: bool = False) -> DataFrame:
    """NULL count and share of every column from a single pass.

    One row of counters is unpivoted, instead of one job per column. ``count_nan`` counts NaN
    in floating-point columns as missing, too.
    """

    def missing(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if count_nan and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return column.isNull() | F.isnan(column)
        return column.isNull()

    return profile_of_flags(df.select(*[missing(f).alias(f.name) for f in df.schema.fields]))


def profile_of_flags(df: DataFrame) -> DataFrame:
    """:func:`null_profile` of rows that show for each column whether its value is missing.

    Flags can be set where a column lives; joining them instead of the values keeps wide text out of joins.
    """
    counters = [F.count_if(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]
    counted = df.agg(F.count("*").alias("row_count"), *counters)
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"))
        for i, c in enumerate(df.columns)
    ]
    long_form = counted.select("row_count", F.explode(F.array(*entries)).alias("e"))
    share = F.try_divide(F.col("e.null_count") * 100.0, F.col("row_count"))
    return long_form.select(
        "e.column_name",
        "e.null_count",
        F.round(F.coalesce(share, F.lit(0.0)), 2).alias("null_percentage"),
    )


def schema_violations(df: DataFrame, schema: T.StructType) -> Column:
    """Names of declared fields a text row cannot satisfy, NULL when it satisfies all."""
    problems = []
    for field in schema.fields:
        source = F.col(f"`{field.name}`")
        unreadable = source.isNotNull() & source.try_cast(field.dataType).isNull()
        problems.append(F.when(unreadable, f"{field.name}: not {field.dataType.simpleString()}"))
        if not field.nullable:
            problems.append(F.when(source.isNull(), f"{field.name}: null"))
    return F.nullif(F.concat_ws("; ", *problems), F.lit(""))


def enforce_schema(df: DataFrame, schema: T.StructType, mode: str = "fail"):
    """Make rows conform to ``schema``.

    ``fail`` returns the typed frame and raises at run time on the first bad row;
    ``quarantine`` returns (typed good rows, bad rows with ``_violation``). A declared column
    that is absent raises ``ValueError`` in both modes.
    """
    absent = [f.name for f in schema.fields if f.name not in df.columns]
    if absent:
        raise ValueError(f"Missing required columns: {absent}")
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    flagged = df.withColumn("_violation", schema_violations(df, schema))
    if mode == "quarantine":
        good = flagged.filter(F.col("_violation").isNull()).select(*typed)
        return good, flagged.filter(F.col("_violation").isNotNull())
    if mode != "fail":
        raise ValueError(f"mode must be 'fail' or 'quarantine', not {mode!r}")
    verdict = F.when(F.col("_violation").isNotNull(), F.raise_error(F.col("_violation"))).otherwise(True)
    return flagged.filter(verdict).select(*typed)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def freshness(df: DataFrame, ts: str, as_of: str, max_age_days: int) -> DataFrame:
    """Age of the newest row against a given date."""
    newest = df.agg(F.max(F.to_date(F.col(ts))).alias("newest_date"))
    age = F.date_diff(F.to_date(F.lit(as_of)), F.col("newest_date"))
    return newest.withColumns({"age_days": age, "is_fresh": is_true(age <= max_age_days)})
