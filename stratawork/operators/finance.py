"""Price series: returns, volatility, validation, summary, portfolio.

Series are ordered by ``order`` (the date by default), which must be unique within a series. A series of any length
is fine: long ones are cut into blocks that overlap by the rows a window looks back. Where there is
one row a day by construction, ``max_group_rows=None`` spares the measurement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.labels import performance_tier
from ..functions.numbers import percent, percent_change
from ..workspace import durable
from .ordered import DEFAULT, in_blocks

SERIES = ["symbol"]
BY_DATE = ["date"]


def _along(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def _daily_return(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    previous = F.lag("close").over(_along(keys, order))
    return df.withColumn("daily_return", F.round(percent_change("close", previous), 4))


def _cumulative_return(df: DataFrame) -> DataFrame:
    return df.withColumn("cumulative_return", F.round(percent_change("close", "__start"), 4))


def _volatility(df: DataFrame, rows: int, column: str, keys: list[str], order: list[str], name: str) -> DataFrame:
    trailing = _along(keys, order).rowsBetween(1 - rows, 0)
    return df.withColumn(name, F.round(F.stddev_samp(column).over(trailing), 4))


def _average(df: DataFrame, rows: int, column: str, keys: list[str], order: list[str], name: str) -> DataFrame:
    trailing = _along(keys, order).rowsBetween(1 - rows, 0)
    mean = F.avg(F.col(column).cast("decimal(28,8)")).over(trailing)
    return df.withColumn(name, F.round(mean, 4).cast("double"))


def calculate_daily_returns(
    df: DataFrame, keys: list[str] = SERIES, order: list[str] = BY_DATE, max_group_rows: int | None = DEFAULT
) -> DataFrame:
    """Change of close against the previous row of the series, in percent."""
    return in_blocks(df, keys, order, 1, lambda rows, by: _daily_return(rows, by, order), max_group_rows=max_group_rows)


def calculate_cumulative_returns(
    df: DataFrame, keys: list[str] = SERIES, order: list[str] = BY_DATE, max_group_rows: int | None = DEFAULT
) -> DataFrame:
    """Change of close against the first row of the series, in percent."""
    start = {"__start": "close"}
    return in_blocks(df, keys, order, 0, lambda rows, _: _cumulative_return(rows), first=start, max_group_rows=max_group_rows)


def calculate_rolling_volatility(
    df: DataFrame,
    window_days: int = 30,
    column: str = "daily_return",
    keys: list[str] = SERIES,
    name: str | None = None,
    order: list[str] = BY_DATE,
    max_group_rows: int | None = DEFAULT,
) -> DataFrame:
    """Sample standard deviation over the last ``window_days`` rows; NULL for fewer than two."""
    name = name or f"rolling_volatility_{window_days}d"
    spread = lambda rows, by: _volatility(rows, window_days, column, by, order, name)
    return in_blocks(df, keys, order, window_days - 1, spread, max_group_rows=max_group_rows)


def calculate_rolling_average(
    df: DataFrame,
    window_days: int = 30,
    column: str = "daily_return",
    keys: list[str] = SERIES,
    name: str | None = None,
    order: list[str] = BY_DATE,
    max_group_rows: int | None = DEFAULT,
) -> DataFrame:
    """Mean over the last ``window_days`` rows, averaged as decimals so that rounding is exact."""
    name = name or f"rolling_average_{window_days}d"
    mean = lambda rows, by: _average(rows, window_days, column, by, order, name)
    return in_blocks(df, keys, order, window_days - 1, mean, max_group_rows=max_group_rows)


def calculate_price_range_metrics(df: DataFrame) -> DataFrame:
    """Intraday range in money and as percentage of close."""
    width = F.col("high") - F.col("low")
    return df.withColumns(
        {
            "daily_range": F.round(width, 2),
            "daily_range_pct": F.round(percent(width, "close"), 4),
        }
    )


def validate(df: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """Quality counters of a price table in one row.

    Rows fold to one per (series, date) with map-side partial counts; duplicates and all other
    counters come out of the same pass.
    """
    prices = ["open", "high", "low", "close"]
    below_zero = F.coalesce(*[F.when(F.col(p) < 0, True) for p in prices], F.lit(False))
    per_day = df.groupBy(*keys, "date").agg(
        F.count("*").alias("copies"),
        F.count_if(F.col("close").isNull()).alias("no_close"),
        F.count_if(below_zero).alias("negative"),
        F.count_if(F.col("high") < F.col("low")).alias("inverted"),
    )

    def total(expr):
        return F.coalesce(F.sum(expr), F.lit(0)).cast("long")

    counters = per_day.agg(
        total("copies").alias("total_records"),
        total(F.when(F.col(keys[0]).isNull(), F.col("copies"))).alias("null_symbols"),
        total(F.when(F.col("date").isNull(), F.col("copies"))).alias("null_dates"),
        total("no_close").alias("null_closes"),
        total("negative").alias("negative_prices"),
        total("inverted").alias("invalid_ranges"),
        F.count_if(F.col("copies") > 1).alias("duplicates"),
    )
    problems = sum((F.col(c) for c in counters.columns[1:]), F.lit(0))
    return counters.withColumn("is_valid", problems == 0)


def validate_stock_data(df: DataFrame) -> dict:
    """The counters of :func:`validate` as a dictionary."""
    row = validate(df).first().asDict()
    nulls = {c: row.pop(f"null_{c}s") for c in ("symbol", "date", "close")}
    return {**row, "null_counts": nulls}


def detailed(
    df: DataFrame, keys: list[str] = SERIES, order: list[str] = BY_DATE, max_group_rows: int | None = DEFAULT
) -> DataFrame:
    """Returns, ranges, 30-row volatility and 30-row mean return.

    All windows share one partitioning and ordering, hence one shuffle and one sort; the measurement
    is made once for all.
    """

    def compute(rows: DataFrame, by: list[str]) -> DataFrame:
        rows = _cumulative_return(_daily_return(rows, by, order))
        rows = _volatility(rows, 30, "daily_return", by, order, "volatility_30d")
        return _average(rows, 30, "daily_return", by, order, "avg_return_30d")

    # 29 earlier returns, and the close before the first of them
    series = in_blocks(df, keys, order, 30, compute, first={"__start": "close"}, max_group_rows=max_group_rows)
    return calculate_price_range_metrics(series)


def summary(returns: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """One row per series. ``total_return_pct`` is the best cumulative return seen,
    ``final_return_pct`` the one on the last date."""
    grouped = returns.groupBy(*keys).agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("*").alias("trading_days"),
        F.round(F.min("close"), 2).alias("min_close"),
        F.round(F.max("close"), 2).alias("max_close"),
        F.round(F.avg("close"), 2).alias("avg_close"),
        F.round(F.max("cumulative_return"), 2).alias("total_return_pct"),
        F.round(F.max_by("cumulative_return", "date"), 2).alias("final_return_pct"),
        F.round(F.avg("daily_return"), 4).alias("avg_daily_return"),
        F.round(F.stddev_samp("daily_return"), 4).alias("volatility"),
        F.round(F.avg("volume"), 0).alias("avg_daily_volume"),
    )
    return grouped.withColumn("performance_tier", performance_tier("total_return_pct"))


def market_overview(summary_df: DataFrame) -> DataFrame:
    """Number of series, mean return, best series and mean volatility."""
    best = F.max_by(F.struct("symbol", "total_return_pct"), F.struct("total_return_pct", "symbol"))
    return summary_df.agg(
        F.count("*").alias("total_stocks"),
        F.round(F.avg("total_return_pct"), 4).alias("avg_return"),
        best.alias("best"),
        F.round(F.avg("volatility"), 6).alias("avg_volatility"),
    ).select(
        "total_stocks",
        "avg_return",
        F.col("best.symbol").alias("best_performer"),
        F.col("best.total_return_pct").alias("best_return"),
        "avg_volatility",
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram between smallest and largest value.

    The range is a one-row aggregate used as scalar subqueries; rows fold into at most
    ``bins`` counters on the map side. The column is written once, so that neither pass repeats the
    work behind it.
    """
    known = durable(df.select(column).filter(F.col(column).isNotNull()), "histogram")
    low = known.agg(F.min(column)).scalar()
    high = known.agg(F.max(column)).scalar()
    width = (high - low) / bins
    position = F.floor(F.try_divide(F.col(column) - low, width))
    bin_no = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return known.groupBy(bin_no.alias("bin")).agg(
        F.count("*").alias("frequency"), F.min(column).alias("bin_min"), F.max(column).alias("bin_max")
    )


def price_history(df: DataFrame, symbol: str, start: str, end: str) -> DataFrame:
    """Rows of one series between two dates through bound parameters, never string pasting."""
    return df.sparkSession.sql(
        "SELECT * FROM {prices} WHERE symbol = :symbol"
        " AND date BETWEEN to_date(:start) AND to_date(:end) ORDER BY date",
        args={"symbol": symbol, "start": start, "end": end},
        prices=df,
    )


def portfolio(summary_df: DataFrame, holdings: DataFrame) -> DataFrame:
    """Value and return of each holding (symbol, shares)."""
    value = F.col("shares") * F.col("avg_close")
    return holdings.join(summary_df, "symbol").select(
        "symbol",
        "shares",
        "avg_close",
        value.alias("value"),
        (value * F.col("total_return_pct") / 100.0).alias("return_value"),
    )


def portfolio_total(positions: DataFrame) -> DataFrame:
    totals = positions.agg(
        F.sum("value").alias("total_value"), F.sum("return_value").alias("total_return")
    )
    return totals.withColumn("total_return_pct", percent("total_return", "total_value"))
