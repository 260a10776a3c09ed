"""Cleansing and data-quality queries over dirty copies of orders and customers."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..catalog import distinct_schema_names
from ..functions.names import schema_name
from ..operators import quality as dq
from ..operators.cleanse import (
    clean_customers,
    clean_orders,
    fill_missing_values,
    remove_duplicates,
    standardize_string_columns,
)
from ..operators.sales import revenue
from ..functions.numbers import money_mean, money_sum
from .flows import LayerFolders, quarantine
from .registry import query
from .views import (
    CLEAN_ORDERS_SQL,
    DIRTY_CUSTOMERS_SQL,
    RAW_ORDERS_SQL,
    SALES_SQL,
    dirty_customers,
    raw_orders,
    sales,
    table,
)

WITH_CUSTOMERS = f"WITH {DIRTY_CUSTOMERS_SQL} "
WITH_CLEAN_ORDERS = f"WITH {CLEAN_ORDERS_SQL} "
_CUSTOMER_COLUMNS = "customer_id, name, email, age, lifetime_value, copy_no"

# The published e-mail rule; the SQL below must use the same text.
_EMAIL = dq.EMAIL_PATTERN


@query(
    "dedup_keep",
    f"WITH {RAW_ORDERS_SQL} SELECT order_id, amount, copy_no FROM (SELECT *, max(copy_no) OVER"
    " (PARTITION BY order_id) AS last_copy FROM raw_orders) WHERE copy_no = last_copy",
)
def dedup_keep(spark, sf):
    raw = raw_orders(spark, sf).select("order_id", "amount", "copy_no")
    return remove_duplicates(raw, ["order_id"], keep="last", order_by=["copy_no"])


@query(
    "dedup_any",
    f"WITH {RAW_ORDERS_SQL} SELECT DISTINCT order_id, customer_email, amount, status FROM raw_orders",
)
def dedup_any(spark, sf):
    return remove_duplicates(raw_orders(spark, sf).select("order_id", "customer_email", "amount", "status"))


@query(
    "duplicate_keys",
    f"WITH {RAW_ORDERS_SQL} SELECT order_id, count(*) AS copies FROM raw_orders GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_keys(spark, sf):
    return dq.duplicate_keys(raw_orders(spark, sf), ["order_id"])


_SILVER_SQL = (
    "SELECT order_id, customer_email, product, amount, CAST(order_date AS VARCHAR) AS order_date,"
    " status, is_valid FROM clean_orders"
)


@query("silver_orders", WITH_CLEAN_ORDERS + _SILVER_SQL)
def silver_orders(spark, sf):
    silver = clean_orders(raw_orders(spark, sf), order_by=["copy_no"])
    return silver.drop("copy_no").withColumn("order_date", F.to_date("order_date"))


def daily_order_gold(silver):
    """Valid completed orders per day."""
    done = silver.filter(F.col("is_valid") & (F.col("status") == "completed"))
    return (
        done.groupBy(F.to_date("order_date").alias("order_date"))
        .agg(
            F.count("order_id").alias("total_orders"),
            money_sum("amount").alias("total_revenue"),
            money_mean("amount").alias("avg_order_value"),
        )
        .orderBy("order_date")
    )


GOLD_ORDERS_SQL = (
    WITH_CLEAN_ORDERS
    + "SELECT CAST(order_date AS VARCHAR) AS order_date, count(*) AS total_orders,"
    " CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,"
    " CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_order_value"
    " FROM clean_orders WHERE is_valid AND status = 'completed' GROUP BY clean_orders.order_date"
)


@query("gold_daily_orders", GOLD_ORDERS_SQL)
def gold_daily_orders(spark, sf):
    return daily_order_gold(clean_orders(raw_orders(spark, sf), order_by=["copy_no"]))


# Row checks

_VALID_SALE = "customer_id IS NOT NULL AND age > 0 AND lifetime_value > 0"


def _valid_customer():
    return F.col("customer_id").isNotNull() & (F.col("age") > 0) & (F.col("lifetime_value") > 0)


@query("dq_good", WITH_CUSTOMERS + f"SELECT {_CUSTOMER_COLUMNS} FROM dirty_customers WHERE {_VALID_SALE}")
def dq_good(spark, sf):
    return dq.split_rows(dirty_customers(spark, sf).drop("country"), _valid_customer())[0]


@query(
    "dq_quarantine",
    WITH_CUSTOMERS
    + f"SELECT {_CUSTOMER_COLUMNS} FROM dirty_customers WHERE ({_VALID_SALE}) IS NOT TRUE",
)
def dq_quarantine(spark, sf):
    return dq.split_rows(dirty_customers(spark, sf).drop("country"), _valid_customer())[1]


@query(
    "quarantine_split",
    WITH_CUSTOMERS
    + f"SELECT {_CUSTOMER_COLUMNS}, CASE WHEN {_VALID_SALE} THEN 'accepted' ELSE 'quarantined' END AS route FROM dirty_customers",
)
def quarantine_split(spark, sf):
    """Both sides land in their layers; the customers are worked out once."""
    return quarantine(dirty_customers(spark, sf).drop("country"), LayerFolders(spark, "quarantine"), _valid_customer())


_CHECKS = {
    "completeness_check": "CASE WHEN customer_id IS NULL THEN 'FAIL: customer_id is null'"
    " WHEN name IS NULL THEN 'FAIL: name is null' WHEN email IS NULL THEN 'FAIL: email is null'"
    " ELSE 'PASS' END",
    "accuracy_check": "CASE WHEN age < 0 OR age > 120 THEN 'FAIL: age out of valid range (0-120)'"
    " WHEN lifetime_value < 0 THEN 'FAIL: negative lifetime value'"
    " WHEN lifetime_value = 0 THEN 'WARN: zero lifetime value' ELSE 'PASS' END",
    "consistency_check": f"CASE WHEN NOT regexp_matches(email, '{_EMAIL}') THEN 'FAIL: invalid email format'"
    " ELSE 'PASS' END",
}


def _check_query(name: str, check: str):
    @query(
        name,
        WITH_CUSTOMERS + f"SELECT customer_id, copy_no, {_CHECKS[check]} AS {check} FROM dirty_customers",
    )
    def run(spark, sf):
        checked = dirty_customers(spark, sf).withColumn(check, dq.customer_checks()[check])
        return checked.select("customer_id", "copy_no", check)


_check_query("dq_completeness", "completeness_check")
_check_query("dq_accuracy", "accuracy_check")
_check_query("dq_consistency", "consistency_check")

_SCORED_SQL = (
    DIRTY_CUSTOMERS_SQL
    + ", checked AS (SELECT *, "
    + ", ".join(f"{sql} AS {name}" for name, sql in _CHECKS.items())
    + " FROM dirty_customers), issues AS (SELECT *, concat_ws('; ', "
    + ", ".join(f"CASE WHEN {name} <> 'PASS' THEN {name} END" for name in _CHECKS)
    + ") AS quality_issues FROM checked), scored AS (SELECT *, CASE"
    " WHEN contains(quality_issues, 'FAIL') THEN 'FAILED'"
    " WHEN contains(quality_issues, 'WARN') THEN 'WARNING' ELSE 'PASSED' END AS quality_status FROM issues)"
)


@query(
    "dq_scored",
    f"WITH {_SCORED_SQL} SELECT customer_id, copy_no, quality_issues, quality_status FROM scored",
)
def dq_scored(spark, sf):
    scored = dq.with_quality_score(dirty_customers(spark, sf), dq.customer_checks())
    return scored.select("customer_id", "copy_no", "quality_issues", "quality_status")


@query(
    "dq_status_counts",
    f"WITH {_SCORED_SQL} SELECT quality_status, count(*) AS record_count FROM scored GROUP BY 1",
)
def dq_status_counts(spark, sf):
    return dq.status_counts(dq.with_quality_score(dirty_customers(spark, sf), dq.customer_checks()))


@query(
    "dq_routed_silver",
    f"WITH {_SCORED_SQL} SELECT customer_id, copy_no, quality_status FROM scored WHERE quality_status <> 'FAILED'",
)
def dq_routed_silver(spark, sf):
    kept, _ = dq.route_by_status(dq.with_quality_score(dirty_customers(spark, sf), dq.customer_checks()))
    return kept.select("customer_id", "copy_no", "quality_status")


@query(
    "dq_required_split",
    WITH_CUSTOMERS
    + "SELECT customer_id, copy_no, name IS NOT NULL AND email IS NOT NULL AS is_good FROM dirty_customers",
)
def dq_required_split(spark, sf):
    needed = ["customer_id", "name", "email"]
    good, bad = dq.validate_data_quality(dirty_customers(spark, sf), needed, needed)

    def labelled(df, verdict):
        return df.select("customer_id", "copy_no", F.lit(verdict).alias("is_good"))

    return labelled(good, True).unionByName(labelled(bad, False))


@query(
    "sales_quarantine_counts",
    f"WITH {SALES_SQL} SELECT quantity > 5 AND total_amount > 10000 AS is_valid, count(*) AS transactions,"
    " CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM sales GROUP BY 1",
)
def sales_quarantine_counts(spark, sf):
    """Accepted and quarantined rows counted in one pass over the flag."""
    df = sales(spark, sf, "quantity", "total_amount")
    verdict = dq.is_true((F.col("quantity") > 5) & (F.col("total_amount") > 10000))
    return revenue(df, [verdict.alias("is_valid")])


_READINGS = "CASE WHEN event_id % 7 = 0 THEN {nan} WHEN event_id % 11 = 0 THEN NULL ELSE value END"
_SHARE = "round(missing * 100.0 / (SELECT count(*) FROM events), 2)"


@query(
    "missing_readings",
    f"SELECT column_name, missing AS null_count, {_SHARE} AS null_percentage FROM ("
    "SELECT 'event_id' AS column_name, count(*) FILTER (event_id IS NULL) AS missing FROM events UNION ALL"
    " SELECT 'user_id', count(*) FILTER (user_id IS NULL) FROM events UNION ALL"
    " SELECT 'reading', count(*) FILTER (r IS NULL OR isnan(r)) FROM"
    f" (SELECT {_READINGS.format(nan="'NaN'::DOUBLE")} AS r FROM events))",
)
def missing_readings(spark, sf):
    """NULL and NaN both count as missing in a floating-point column."""
    readings = _READINGS.format(nan="double('NaN')")
    return dq.null_profile(table(spark, sf, "events").selectExpr("event_id", "user_id", f"{readings} AS reading"), count_nan=True)


@query(
    "standardize_strings",
    WITH_CUSTOMERS
    + "SELECT customer_id, copy_no, upper(trim(name)) AS name, upper(trim(country)) AS country FROM dirty_customers",
)
def standardize_strings(spark, sf):
    df = dirty_customers(spark, sf).select("customer_id", "copy_no", "name", "country")
    return standardize_string_columns(df, ["name", "country"])


@query(
    "fill_missing",
    WITH_CUSTOMERS
    + "SELECT customer_id, copy_no, coalesce(email, name) AS email,"
    " coalesce(lifetime_value, 0.0) AS lifetime_value, name FROM dirty_customers",
)
def fill_missing(spark, sf):
    df = dirty_customers(spark, sf).select("customer_id", "copy_no", "email", "lifetime_value", "name")
    filled = fill_missing_values(df, "email", fill_with_column="name")
    return fill_missing_values(filled, "lifetime_value", fill_value=0.0)


@query(
    "customers_clean",
    WITH_CUSTOMERS
    + "SELECT customer_id, upper(trim(name)) AS name, coalesce(email, 'unknown@example.com') AS email,"
    " coalesce(upper(trim(country)), 'UNKNOWN') AS country, coalesce(lifetime_value, 0.0) AS lifetime_value"
    " FROM dirty_customers WHERE copy_no = 1 AND name IS NOT NULL",
)
def customers_clean(spark, sf):
    good, _ = clean_customers(
        dirty_customers(spark, sf).drop("age"),
        upper=["name", "country"],
        fills={"email": "unknown@example.com", "country": "UNKNOWN", "lifetime_value": 0.0},
        required=["customer_id", "name", "email"],
        order_by=["copy_no"],
    )
    return good.drop("copy_no")


_ORDER_CONTRACT = T.StructType(
    [
        T.StructField("order_id", T.LongType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("order_date", T.DateType(), True),
    ]
)


@query(
    "schema_violations",
    f"WITH {RAW_ORDERS_SQL}, flagged AS (SELECT order_id, copy_no, concat_ws('; ',"
    " CASE WHEN amount IS NOT NULL AND TRY_CAST(amount AS DOUBLE) IS NULL THEN 'amount: not double' END,"
    " CASE WHEN amount IS NULL THEN 'amount: null' END,"
    " CASE WHEN TRY_CAST(order_date AS DATE) IS NULL THEN 'order_date: not date' END) AS violation"
    " FROM raw_orders) SELECT * FROM flagged WHERE violation <> ''",
)
def schema_violations(spark, sf):
    _, bad = dq.enforce_schema(raw_orders(spark, sf), _ORDER_CONTRACT, mode="quarantine")
    return bad.select("order_id", "copy_no", F.col("_violation").alias("violation"))


@query(
    "freshness_check",
    "SELECT CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS newest_date,"
    " CAST(date_diff('day', max(CAST(ts AS DATE)), DATE '2024-02-15') AS INTEGER) AS age_days,"
    " date_diff('day', max(CAST(ts AS DATE)), DATE '2024-02-15') <= 10 AS is_fresh FROM events",
)
def freshness_check(spark, sf):
    return dq.freshness(table(spark, sf, "events"), "ts", "2024-02-15", 10)


# Schema names from e-mail addresses

_USERS_SQL = """users AS (
  SELECT c_custkey AS user_id,
         'User.' || CAST(c_custkey % 397 AS VARCHAR) || '+' || c_mktsegment || '@host'
         || CAST(c_custkey AS VARCHAR) || '.org' AS email FROM customer)"""
_BASE_SQL = "lower(regexp_replace(split_part(email, '@', 1), '[^a-zA-Z0-9_]', '_', 'g'))"


def _users(spark, sf):
    key = F.col("c_custkey")
    email = F.concat(
        F.lit("User."),
        (key % 397).cast("string"),
        F.lit("+"),
        F.col("c_mktsegment"),
        F.lit("@host"),
        key.cast("string"),
        F.lit(".org"),
    )
    return table(spark, sf, "customer").select(key.alias("user_id"), email.alias("email"))


@query(
    "schema_name_from_email",
    f"WITH {_USERS_SQL} SELECT user_id, email, {_BASE_SQL} AS schema_name FROM users",
)
def schema_name_from_email(spark, sf):
    return _users(spark, sf).withColumn("schema_name", schema_name("email"))


@query(
    "schema_name_dedup",
    f"WITH {_USERS_SQL}, based AS (SELECT user_id, email, {_BASE_SQL} AS base_name FROM users)"
    " SELECT user_id, email, CASE WHEN count(*) OVER (PARTITION BY base_name) > 1"
    " THEN base_name || '_' || CAST(row_number() OVER (PARTITION BY base_name ORDER BY email) AS VARCHAR)"
    " ELSE base_name END AS schema_name FROM based",
)
def schema_name_dedup(spark, sf):
    based = _users(spark, sf).withColumn("base_name", schema_name("email"))
    return distinct_schema_names(based).drop("base_name")
