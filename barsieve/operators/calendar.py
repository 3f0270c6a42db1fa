"""Trading days: ranges, expected files, missing days and the ingest audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsieve.functions.days import archive_location, archive_name, day_folder, file_in_path


def day_bounds(df: DataFrame, date_col: str, by: tuple[str, ...] = ()) -> DataFrame:
    """First and last day of a table, or of each group of it."""
    day = F.col(date_col).cast("date")
    return df.groupBy(*by).agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))


def day_range(bounds: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Every day from `start_date` to `end_date`, both included, for each row of bounds."""
    first, last = F.col("start_date").cast("date"), F.col("end_date").cast("date")
    return bounds.where(first <= last).select(*by, F.explode(F.sequence(first, last)).alias("trade_date"))


def expected_files(days: DataFrame, base: str) -> DataFrame:
    """Day folder, archive name and archive location of each trading day."""
    day = F.col("trade_date")
    return days.select(
        "trade_date",
        day_folder(day).alias("day_folder"),
        archive_name(day).alias("file_name"),
        archive_location(day, base).alias("location"),
    )


def available_days(days: DataFrame, listing: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Days of the range that occur in the listing."""
    on = [*by, "trade_date"]
    return days.join(listing.select(*on).distinct(), on, "left_semi")


def missing_days(days: DataFrame, listing: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Days of the range that do not occur in the listing.

    The listing is reduced to its distinct days first; Spark broadcasts them if they are few enough.
    """
    on = [*by, "trade_date"]
    return days.join(listing.select(*on).distinct(), on, "left_anti")


def missing_within(df: DataFrame, date_col: str, listed: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Days between the first and last day of a table, or of each group of it, without a row that is `listed`.

    One pass: the rows are reduced to days, and a group's days, as many as the calendar has, to one row.
    """
    day = F.col(date_col).cast("date").alias("_day")
    days = df.groupBy(*by, day).agg(F.max(F.coalesce(listed, F.lit(False))).alias("_listed"))
    spans = days.groupBy(*by).agg(
        F.min("_day").alias("_first"),
        F.max("_day").alias("_last"),
        F.collect_list(F.when(F.col("_listed"), F.col("_day"))).alias("_days"),
    )
    missing = F.array_except(F.sequence("_first", "_last"), F.col("_days"))
    return spans.select(*by, F.explode(missing).alias("trade_date"))


def records_per_file(df: DataFrame) -> DataFrame:
    """Records per trade date and source file, per date (file null) and in all (both null).

    Rows are counted per file first, and the totals are rolled up from those counts.
    """
    counted = df.groupBy("trade_date", "source_file").agg(F.count("*").alias("n"))
    return (
        counted.rollup("trade_date", "source_file")
        .agg(F.sum("n").alias("n_records"), F.grouping_id().cast("int").alias("total_level"))
        .select("trade_date", "source_file", "n_records", "total_level")
    )


def files_per_day(listing: DataFrame, name_part: str = ".mkt.gz") -> DataFrame:
    """Files per trade date of a listing with `trade_date` and `path`, and how many have the part in their name."""
    is_market = file_in_path(F.col("path")).contains(name_part)
    return listing.groupBy("trade_date").agg(
        F.count("*").alias("n_files"), F.count_if(is_market).alias("n_market_files")
    )
