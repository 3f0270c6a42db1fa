"""Gold table: spreads, returns and the month's open, high, low and close per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barsieve.functions.prices import percent_return, spread_high_low, spread_open_close

_DAY = "_day"


def monthly_bars(
    df: DataFrame,
    date_col: str = "generated_date",
    series: str | None = "EQ",
    full_month: bool = False,
    on_zero: str = "zero",
    tie_break: list[str] | None = None,
) -> DataFrame:
    """Daily bars with spreads, percent return and the month so far.

    The monthly columns cover the rows of the same symbol and month up to and including the row's day;
    `full_month` makes the close that of the whole month. Rows of one day are ordered by `tie_break`,
    by default all columns, so that the first open and last close do not depend on the row order.

    The rows are reduced to one per symbol and day before the windows, which then see at most 31 rows a month, and
    the result is joined back by symbol and day. So a month may have any number of rows; the input is evaluated twice.
    """
    if series is not None:
        df = df.where(F.col("series") == series)
    columns = df.columns
    ties = [c for c in (columns if tie_break is None else tie_break) if c != date_col]
    day = F.col(date_col).cast("date")
    bars = df.withColumn(_DAY, day)
    result = _with_month(bars, ties, full_month)
    return result.select(
        *columns,
        spread_high_low().alias("spread_high_low"),
        spread_open_close().alias("spread_open_close"),
        percent_return(on_zero).alias("returns_perc"),
        "open_monthly",
        "close_monthly",
        "high_monthly",
        "low_monthly",
    )


def _with_month(bars: DataFrame, ties: list[str], full_month: bool) -> DataFrame:
    """The bars with the monthly columns of their symbol and day."""
    order = F.struct(*(ties or [_DAY]))
    days = bars.groupBy("symbol", _DAY).agg(
        F.min_by("open", order).alias("_open"),
        F.max_by("close", order).alias("_close"),
        F.max("high").alias("_high"),
        F.min("low").alias("_low"),
    )
    so_far = W.partitionBy("symbol", F.year(_DAY), F.month(_DAY)).orderBy(_DAY)
    whole = so_far.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per_day = days.select(
        F.col("symbol").alias("_symbol"),
        F.col(_DAY).alias("_month_day"),
        F.first("_open").over(so_far).alias("open_monthly"),
        F.last("_close").over(whole if full_month else so_far).alias("close_monthly"),
        F.max("_high").over(so_far).alias("high_monthly"),
        F.min("_low").over(so_far).alias("low_monthly"),
    )
    same_day = F.col("symbol").eqNullSafe(F.col("_symbol")) & F.col(_DAY).eqNullSafe(F.col("_month_day"))
    return bars.join(per_day, same_day).drop("_symbol", "_month_day")


def ordered_by_day(df: DataFrame, date_col: str = "generated_date", then: str = "symbol") -> DataFrame:
    """Sort by day, then by symbol, so that a large day may be split over several output partitions."""
    return df.orderBy(date_col, *([then] if then in df.columns else []))
