"""Row counts compared between two stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

SAME = "both have as many rows"
MISSING = "rows that the target lacks: "


def row_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both counts, source minus target, and the outcome in words."""
    source_n = source.agg(F.count("*").alias("source_rows")).withColumn("target_rows", F.lit(0).cast("long"))
    target_n = target.agg(F.count("*").alias("target_rows")).withColumn("source_rows", F.lit(0).cast("long"))
    both = source_n.unionByName(target_n).agg(
        F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows")
    )
    return _compared(both)


def written_counts(source: DataFrame, kept: Column, write: Callable[[DataFrame], None]) -> DataFrame:
    """The same row for a write of the rows for which `kept` holds, counted by the tasks that write them.

    Neither side is read for its count. `write` has to run the frame that it gets once, to the end.
    """
    read, wrote = Observation(), Observation()
    rows = source.observe(read, F.count(F.lit(1)).alias("n")).where(kept)
    write(rows.observe(wrote, F.count(F.lit(1)).alias("n")))
    counts = {"source_rows": read.get["n"], "target_rows": wrote.get["n"]}
    return _compared(source.sparkSession.range(1).select(*[F.lit(n).cast("long").alias(c) for c, n in counts.items()]))


def _compared(counts: DataFrame) -> DataFrame:
    difference = F.col("source_rows") - F.col("target_rows")
    return counts.select(
        "source_rows",
        "target_rows",
        difference.alias("missing_rows"),
        F.when(difference == 0, SAME).otherwise(F.concat(F.lit(MISSING), difference.cast("string"))).alias("status"),
    )
