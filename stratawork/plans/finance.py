"""Price series and campaign queries derived from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import risk_level
from ..functions.numbers import money_mean
from ..operators import finance as op
from ..operators.campaigns import campaign_metrics, campaign_totals
from .registry import query
from .views import CAMPAIGNS_SQL, STOCK_SQL, campaigns, stock, table

WITH_STOCK = f"WITH {STOCK_SQL} "
_DAY = "CAST(date AS VARCHAR) AS date"
_RETURN = "round((close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) * 100, 4)"
_TOTAL = "round((close - first_value(close) OVER w) / nullif(first_value(close) OVER w, 0) * 100, 4)"
_SERIES = "WINDOW w AS (PARTITION BY symbol ORDER BY date)"
_TRAIL = "(PARTITION BY symbol ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
# Mean of returns in units of 1/10000, rounded half up in whole numbers.
_UNITS = f"sum(CAST(round(daily_return * 10000) AS BIGINT)) OVER {_TRAIL}"
_SEEN = f"count(daily_return) OVER {_TRAIL}"
_HALF_UP_MEAN = (
    f"CAST(sign({_UNITS}) * ((2 * abs({_UNITS}) + {_SEEN}) // nullif(2 * {_SEEN}, 0)) AS BIGINT)"
    " / 10000.0::DOUBLE"
)
RETURNS_SQL = (
    STOCK_SQL
    + f""", returns AS (
  SELECT *, {_RETURN} AS daily_return, {_TOTAL} AS cumulative_return FROM stock {_SERIES}),
detailed AS (
  SELECT *, round(stddev_samp(daily_return) OVER {_TRAIL}, 4) AS volatility_30d,
         {_HALF_UP_MEAN} AS avg_return_30d,
         round(high - low, 2) AS daily_range,
         round((high - low) / nullif(close, 0) * 100, 4) AS daily_range_pct
  FROM returns)"""
)
SUMMARY_SQL = (
    RETURNS_SQL
    + """, summed AS (
  SELECT symbol, min(date) AS first_date, max(date) AS last_date, count(*) AS trading_days,
         round(min(close), 2) AS min_close, round(max(close), 2) AS max_close,
         round(avg(close), 2) AS avg_close, round(max(cumulative_return), 2) AS total_return_pct,
         round(arg_max(cumulative_return, date), 2) AS final_return_pct,
         round(avg(daily_return), 4) AS avg_daily_return,
         round(stddev_samp(daily_return), 4) AS volatility,
         round(avg(volume), 0) AS avg_daily_volume
  FROM returns GROUP BY symbol),
summary AS (
  SELECT *, CASE WHEN total_return_pct > 50 THEN 'High Performer'
                 WHEN total_return_pct > 20 THEN 'Good Performer'
                 WHEN total_return_pct > 0 THEN 'Positive' ELSE 'Negative' END AS performance_tier
  FROM summed)"""
)
WITH_RETURNS = f"WITH {RETURNS_SQL} "
WITH_SUMMARY = f"WITH {SUMMARY_SQL} "


#: ``stock`` has one row a day by construction.
ONE_A_DAY = {"max_group_rows": None}


def _returns(spark, sf):
    return op.calculate_cumulative_returns(op.calculate_daily_returns(stock(spark, sf), **ONE_A_DAY), **ONE_A_DAY)


def _summary(spark, sf):
    return op.summary(_returns(spark, sf))


@query("daily_returns", WITH_RETURNS + f"SELECT symbol, {_DAY}, close, daily_return FROM returns")
def daily_returns(spark, sf):
    return op.calculate_daily_returns(stock(spark, sf), **ONE_A_DAY).select("symbol", "date", "close", "daily_return")


@query("cumulative_returns", WITH_RETURNS + f"SELECT symbol, {_DAY}, close, cumulative_return FROM returns")
def cumulative_returns(spark, sf):
    df = op.calculate_cumulative_returns(stock(spark, sf), **ONE_A_DAY)
    return df.select("symbol", "date", "close", "cumulative_return")


@query(
    "rolling_volatility",
    WITH_RETURNS + f"SELECT symbol, {_DAY}, volatility_30d AS rolling_volatility_30d FROM detailed",
)
def rolling_volatility(spark, sf):
    df = op.calculate_rolling_volatility(op.calculate_daily_returns(stock(spark, sf), **ONE_A_DAY), **ONE_A_DAY)
    return df.select("symbol", "date", "rolling_volatility_30d")


@query(
    "rolling_avg_return",
    WITH_RETURNS + f"SELECT symbol, {_DAY}, avg_return_30d AS rolling_average_30d FROM detailed",
)
def rolling_avg_return(spark, sf):
    df = op.calculate_rolling_average(op.calculate_daily_returns(stock(spark, sf), **ONE_A_DAY), **ONE_A_DAY)
    return df.select("symbol", "date", "rolling_average_30d")


@query("price_range", WITH_RETURNS + f"SELECT symbol, {_DAY}, daily_range, daily_range_pct FROM detailed")
def price_range(spark, sf):
    df = op.calculate_price_range_metrics(stock(spark, sf))
    return df.select("symbol", "date", "daily_range", "daily_range_pct")


_DETAIL = "daily_return, cumulative_return, volatility_30d, avg_return_30d, daily_range, daily_range_pct"


@query("stock_detailed", WITH_RETURNS + f"SELECT symbol, {_DAY}, close, volume, {_DETAIL} FROM detailed")
def stock_detailed(spark, sf):
    return op.detailed(stock(spark, sf), **ONE_A_DAY).drop("open", "high", "low")


def _per_symbol_and_user(text: str) -> str:
    return (
        text.replace("event_type AS symbol, CAST(ts AS DATE)", "event_type AS symbol, user_id, CAST(ts AS DATE)")
        .replace("GROUP BY 1, 2)", "GROUP BY 1, 2, 3)")
        .replace("PARTITION BY symbol ", "PARTITION BY symbol, user_id ")
    )


@query(
    "user_series_detailed",
    "WITH "
    + _per_symbol_and_user(RETURNS_SQL)
    + f" SELECT symbol, user_id, {_DAY}, close, volume, {_DETAIL} FROM detailed",
)
def user_series_detailed(spark, sf):
    """The same analytics on one series per symbol and user, whose number grows with the data."""
    prices = stock(spark, sf, "user_id")
    return op.detailed(prices, ["symbol", "user_id"], **ONE_A_DAY).drop("open", "high", "low")


_TICKS_SQL = RETURNS_SQL.replace(
    STOCK_SQL,
    """stock AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 'INDEX' ELSE 'U' || user_id % 40 END AS symbol, event_id, ts AS date,
         value + event_id % 5 AS high, value - event_id % 3 AS low, value AS close
  FROM events)""",
).replace("ORDER BY date", "ORDER BY date, event_id")


@query("intraday_detailed", f"WITH {_TICKS_SQL} SELECT symbol, event_id, close, {_DETAIL} FROM detailed")
def intraday_detailed(spark, sf):
    """One row per event; one symbol holds a third of all rows, so its series grows with the data."""
    symbol = "CASE WHEN event_id % 3 = 0 THEN 'INDEX' ELSE 'U' || user_id % 40 END AS symbol"
    prices = ["value + event_id % 5 AS high", "value - event_id % 3 AS low", "value AS close"]
    ticks = table(spark, sf, "events").selectExpr(symbol, "event_id", "ts AS date", *prices)
    return op.detailed(ticks, order=["date", "event_id"]).drop("date", "high", "low")


@query(
    "stock_summary",
    WITH_SUMMARY
    + "SELECT * REPLACE (CAST(first_date AS VARCHAR) AS first_date, CAST(last_date AS VARCHAR) AS last_date)"
    " FROM summary",
)
def stock_summary(spark, sf):
    return _summary(spark, sf)


@query(
    "stock_validation",
    WITH_STOCK
    + "SELECT CAST(count(*) AS BIGINT) AS total_records, count(*) FILTER (symbol IS NULL) AS null_symbols,"
    " count(*) FILTER (date IS NULL) AS null_dates, count(*) FILTER (close IS NULL) AS null_closes,"
    " count(*) FILTER (open < 0 OR high < 0 OR low < 0 OR close < 0) AS negative_prices,"
    " count(*) FILTER (high < low) AS invalid_ranges,"
    " count(*) - count(DISTINCT (symbol, date)) AS duplicates, true AS is_valid FROM stock",
)
def stock_validation(spark, sf):
    return op.validate(stock(spark, sf))


@query(
    "event_price_validation",
    "WITH days AS (SELECT event_type, CAST(ts AS DATE) AS date, count(*) AS copies FROM events GROUP BY 1, 2)"
    " SELECT CAST(sum(copies) AS BIGINT) AS total_records, 0::BIGINT AS null_symbols, 0::BIGINT AS null_dates,"
    " 0::BIGINT AS null_closes,"
    " (SELECT count(*) FROM events WHERE value - 5 < 0) AS negative_prices,"
    " (SELECT count(*) FROM events WHERE value - 1 < value - 5) AS invalid_ranges,"
    " count(*) FILTER (copies > 1) AS duplicates, false AS is_valid FROM days",
)
def event_price_validation(spark, sf):
    """Raw events read as prices fail the checks: repeated days and prices below zero."""
    value = F.col("value")
    prices = table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"),
        F.to_date("ts").alias("date"),
        value.alias("open"),
        (value - 1).alias("high"),
        (value - 5).alias("low"),
        value.alias("close"),
    )
    return op.validate(prices)


@query(
    "stock_history_range",
    WITH_STOCK
    + f"SELECT symbol, {_DAY}, open, high, low, close, volume FROM stock WHERE symbol = 'click'"
    " AND stock.date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
)
def stock_history_range(spark, sf):
    return op.price_history(stock(spark, sf), "click", "2024-01-05", "2024-01-20")


@query(
    "avg_close_since",
    WITH_STOCK
    + "SELECT symbol, CAST(sum(CAST(close AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_close"
    " FROM stock WHERE date >= DATE '2024-01-10' GROUP BY 1",
)
def avg_close_since(spark, sf):
    recent = stock(spark, sf).filter(F.col("date") >= F.to_date(F.lit("2024-01-10")))
    return recent.groupBy("symbol").agg(money_mean("close").alias("avg_close"))


@query("distinct_symbols", "SELECT DISTINCT event_type AS symbol FROM events")
def distinct_symbols(spark, sf):
    return table(spark, sf, "events").select(F.col("event_type").alias("symbol")).distinct()


@query("distinct_symbol_count", "SELECT count(DISTINCT event_type) AS symbols FROM events")
def distinct_symbol_count(spark, sf):
    """Distinct first, then count: the values fold on the map side."""
    symbols = table(spark, sf, "events").select("event_type").distinct()
    return symbols.agg(F.count("event_type").alias("symbols"))


@query(
    "market_overview",
    WITH_SUMMARY
    + "SELECT count(*) AS total_stocks, round(avg(total_return_pct), 4) AS avg_return,"
    " arg_max(symbol, (total_return_pct, symbol)) AS best_performer, max(total_return_pct) AS best_return,"
    " round(avg(volatility), 6) AS avg_volatility FROM summary",
)
def market_overview(spark, sf):
    return op.market_overview(_summary(spark, sf))


@query(
    "best_performer",
    WITH_SUMMARY
    + "SELECT symbol, total_return_pct FROM summary ORDER BY total_return_pct DESC, symbol LIMIT 1",
)
def best_performer(spark, sf):
    ordered = _summary(spark, sf).orderBy(F.desc("total_return_pct"), "symbol")
    return ordered.select("symbol", "total_return_pct").limit(1)


@query(
    "return_histogram",
    WITH_RETURNS
    + ", known AS (SELECT daily_return AS r FROM returns WHERE daily_return IS NOT NULL),"
    " span AS (SELECT min(r) AS lo, (max(r) - min(r)) / 30 AS w FROM known)"
    " SELECT CAST(least(floor((r - lo) / w), 29) AS INTEGER) AS bin, count(*) AS frequency,"
    " min(r) AS bin_min, max(r) AS bin_max FROM known, span GROUP BY 1",
)
def return_histogram(spark, sf):
    return op.histogram(op.calculate_daily_returns(stock(spark, sf), **ONE_A_DAY), "daily_return", 30)


@query(
    "value_histogram",
    "WITH span AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM events)"
    " SELECT CAST(least(floor((value - lo) / w), 29) AS INTEGER) AS bin, count(*) AS frequency,"
    " min(value) AS bin_min, max(value) AS bin_max FROM events, span GROUP BY 1",
)
def value_histogram(spark, sf):
    return op.histogram(table(spark, sf, "events"), "value", 30)


@query(
    "risk_level",
    WITH_SUMMARY
    + "SELECT symbol, volatility, CASE WHEN volatility < 1 THEN 'Low' WHEN volatility <= 2 THEN 'Medium'"
    " WHEN volatility > 2 THEN 'High' END AS risk_level FROM summary",
)
def risk_level_query(spark, sf):
    return _summary(spark, sf).select("symbol", "volatility", risk_level("volatility").alias("risk_level"))


# Holdings: as many shares of a symbol as users traded it, for three chosen symbols.
_HOLDINGS_SQL = (
    ", holdings AS (SELECT event_type AS symbol, count(DISTINCT user_id) AS shares FROM events"
    " WHERE event_type IN ('click', 'purchase', 'view') GROUP BY 1),"
    " positions AS (SELECT symbol, shares, avg_close, shares * avg_close AS value,"
    " shares * avg_close * total_return_pct / 100.0::DOUBLE AS return_value"
    " FROM holdings JOIN summary USING (symbol))"
)


def _positions(spark, sf):
    chosen = table(spark, sf, "events").filter(F.col("event_type").isin("click", "purchase", "view"))
    holders = chosen.select(F.col("event_type").alias("symbol"), "user_id").distinct()
    holdings = holders.groupBy("symbol").agg(F.count("*").alias("shares"))
    return op.portfolio(_summary(spark, sf), holdings)


@query("portfolio_value", WITH_SUMMARY + _HOLDINGS_SQL + " SELECT * FROM positions")
def portfolio_value(spark, sf):
    return _positions(spark, sf)


@query(
    "portfolio_total",
    WITH_SUMMARY
    + _HOLDINGS_SQL
    + " SELECT round(sum(value), 4) AS total_value, round(sum(return_value), 4) AS total_return,"
    " round(sum(return_value) / sum(value) * 100, 6) AS total_return_pct FROM positions",
)
def portfolio_total(spark, sf):
    totals = op.portfolio_total(_positions(spark, sf))
    return totals.select(
        F.round("total_value", 4).alias("total_value"),
        F.round("total_return", 4).alias("total_return"),
        F.round("total_return_pct", 6).alias("total_return_pct"),
    )


# Campaigns

_METRICS_SQL = (
    CAMPAIGNS_SQL
    + ", metrics AS (SELECT *, round(CAST(clicks AS DOUBLE) / nullif(impressions, 0) * 100, 2) AS ctr,"
    " round(CAST(conversions AS DOUBLE) / nullif(clicks, 0) * 100, 2) AS conversion_rate,"
    " CAST(revenue AS DOUBLE) / nullif(CAST(budget AS DOUBLE), 0) AS raw_roas FROM campaigns)"
)


@query(
    "campaign_metrics",
    f"WITH {_METRICS_SQL} SELECT user_id, CAST(day AS VARCHAR) AS day, impressions, clicks, conversions,"
    " CAST(revenue AS DOUBLE) AS revenue, CAST(budget AS DOUBLE) AS budget, ctr, conversion_rate,"
    " round(raw_roas, 2) AS roas FROM metrics",
)
def campaign_metrics_query(spark, sf):
    return campaign_metrics(campaigns(spark, sf))


@query(
    "campaign_totals",
    f"WITH {_METRICS_SQL} SELECT CAST(sum(budget) AS DOUBLE) AS total_budget,"
    " CAST(sum(revenue) AS DOUBLE) AS total_revenue, round(avg(round(raw_roas, 2)), 6) AS avg_roas,"
    " CAST(sum(conversions) AS BIGINT) AS total_conversions FROM metrics",
)
def campaign_totals_query(spark, sf):
    return campaign_totals(campaign_metrics(campaigns(spark, sf)))
