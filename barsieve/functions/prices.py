"""Price expressions of the gold table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spread_high_low() -> Column:
    """Low minus high, so zero or negative."""
    return F.col("low") - F.col("high")


def spread_open_close() -> Column:
    return F.col("close") - F.col("open")


def percent_return(on_zero: str = "zero") -> Column:
    """Change from the previous close in percent; over a zero previous close either 0 or null."""
    change = (F.col("close") - F.col("prevclose")) * 100
    if on_zero == "zero":
        return F.when(F.col("prevclose") == 0, F.lit(0.0)).otherwise(
            F.try_divide(change, F.col("prevclose"))
        )
    if on_zero == "null":
        return F.try_divide(change, F.col("prevclose"))
    raise ValueError("on_zero must be 'zero' or 'null'")
