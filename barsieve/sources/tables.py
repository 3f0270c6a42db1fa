"""Tables and sinks: any Spark format, options from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barsieve.scratch import scratch_path


def read_table(spark: SparkSession, table: str | None = None, fmt: str | None = None, **options: str) -> DataFrame:
    """A catalog table by name, or what a Spark source format loads; there the table goes in as `dbtable`."""
    if fmt is None:
        return spark.table(table)
    reader = spark.read.format(fmt).options(**options)
    return (reader if table is None else reader.option("dbtable", table)).load()


def overwrite(df: DataFrame, table: str | None = None, fmt: str | None = None, **options: str) -> None:
    """Replace a catalog table, or the target of a Spark sink format, with these rows."""
    if fmt is None:
        create_table(df, table)
        return
    writer = df.write.mode("overwrite").format(fmt).options(**options)
    (writer if table is None else writer.option("dbtable", table)).save()


def create_table(
    df: DataFrame, name: str, fmt: str = "parquet", order_by_day: str | None = None, stage: str | None = None
) -> None:
    """Create or replace a catalog table from the rows, optionally laid out in day order.

    For day order the rows are staged first (in `stage` or the shared folder), so that finding the ranges of days does
    not evaluate them again; each file then holds a range of days and symbols, in order.
    """
    if order_by_day is not None:
        stage = stage or scratch_path(df.sparkSession, "ordered")
        df.write.parquet(stage)
        rows = df.sparkSession.read.schema(df.schema).parquet(stage)
        order = [order_by_day, *(["symbol"] if "symbol" in df.columns else [])]
        df = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.mode("overwrite").format(fmt).saveAsTable(name)


def stage_csv(df: DataFrame, path: str, *partitions: str) -> None:
    """Headed CSV files, one folder per value of the partition columns; without rows nothing is written."""
    df.write.mode("overwrite").option("header", True).partitionBy(*partitions).csv(path)
