"""Row and column counts, constant columns and the minimum-quantity filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts(df: DataFrame) -> DataFrame:
    """Number of rows and of columns, as one row."""
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns")
    )


def constant_columns(df: DataFrame) -> DataFrame:
    """Smallest and largest value per column, as text, and whether the column holds a single value or none.

    One aggregate over all columns; only its single row is turned into one row per column.
    """
    profile = df.agg(
        *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(f"_{i}") for i, c in enumerate(df.columns)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_{i}.lo").cast("string").alias("min_value"),
                F.col(f"_{i}.hi").cast("string").alias("max_value"),
                F.col(f"_{i}.lo").eqNullSafe(F.col(f"_{i}.hi")).alias("is_constant"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return profile.select(F.inline(rows))


def constant_column_names(df: DataFrame) -> list[str]:
    """Names of the constant columns, in column order."""
    flagged = {r["column_name"] for r in constant_columns(df).where("is_constant").collect()}
    return [c for c in df.columns if c in flagged]


def at_least(df: DataFrame, column: str = "Total_Traded_Quantity", minimum: int = 5000) -> DataFrame:
    """Rows whose quantity reaches the minimum."""
    return df.where(F.col(column) >= minimum)
