"""Typed tables from checked text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsieve.functions.declared import ColumnSpec
from barsieve.schemas import BARS_SCHEMA, STAGED_BAR_COLUMNS

# The staged column that has another name in the table.
_RENAMED = {"TIMESTAMP": "generated_date"}


def project_bars(df: DataFrame) -> DataFrame:
    """The staged bar columns in table order, the date column under its table name."""
    return df.select(*[F.col(c).alias(_RENAMED.get(c, c)) for c in STAGED_BAR_COLUMNS])


def typed_value(spec: ColumnSpec, exact_decimals: bool = False) -> Column:
    """The column in its declared type; text that does not fit becomes null instead of failing the job."""
    value = F.col(spec.name)
    if spec.type_check == "date" and spec.date_pattern is not None:
        return F.try_to_date(value, spec.date_pattern).alias(spec.name)
    if spec.type_check == "integer":
        return value.try_cast("bigint").alias(spec.name)
    if spec.type_check == "decimal":
        exact = exact_decimals and spec.precision is not None and spec.scale is not None
        return value.try_cast(T.DecimalType(spec.precision, spec.scale) if exact else "double").alias(spec.name)
    return value.alias(spec.name)


def typed(df: DataFrame, specs: list[ColumnSpec], exact_decimals: bool = False) -> DataFrame:
    """Every declared column in its type: numbers as bigint and double, dates by their format."""
    return df.select(*[typed_value(s, exact_decimals) for s in specs])


def typed_bars(df: DataFrame, date_pattern: str = "dd-MMM-yyyy") -> DataFrame:
    """Projected bars, all text, in the types of the bars table."""
    return df.select(
        *[
            (
                F.try_to_date(F.col(f.name), date_pattern)
                if isinstance(f.dataType, T.DateType)
                else F.col(f.name).try_cast(f.dataType)
            ).alias(f.name)
            for f in BARS_SCHEMA.fields
        ]
    )
