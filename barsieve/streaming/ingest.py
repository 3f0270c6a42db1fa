"""New CSV files are processed once, then moved to an archive folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsieve.functions.declared import ColumnSpec, key_names
from barsieve.functions.predicates import all_present
from barsieve.operators.quality import check
from barsieve.scratch import scratch_path
from barsieve.sources.csv import FILE, SPARE_COLUMNS, by_header, cell_schema
from barsieve.streaming.seen import SeenKeys


def new_files(
    spark: SparkSession, source: str, columns: list[str], archive: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of the lines of CSV files as they appear; consumed files move to the archive folder if given.

    Lines come as cells with their file; `ingest` finds the columns by each file's header. A file is moved some
    batches after it was read, and never read twice even while it is still there.
    """
    reader = spark.readStream.schema(cell_schema(len(columns) + SPARE_COLUMNS))
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(source).select("*", F.col("_metadata.file_path").alias(FILE))


def ingest(stream: DataFrame, columns: list[str], target: str, checkpoint: str) -> str:
    """Add everything that is new to a Parquet folder, exactly once, and stop; returns the folder of this checkpoint.

    A batch goes to `checkpoint=<id>/batch=<number>` and replaces what an interrupted run left there. The id belongs to
    the checkpoint, so a new checkpoint, whose batches are numbered anew, replaces nothing.
    """
    spark = stream.sparkSession
    folder = f"{target}/checkpoint={_checkpoint_id(spark, checkpoint)}"

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = scratch_path(spark, "lines")
        batch.write.parquet(lines)
        rows = by_header(batch.sparkSession.read.schema(batch.schema).parquet(lines), columns)
        rows.drop(FILE).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return folder


def ingest_checked(
    stream: DataFrame,
    columns: list[str],
    specs: list[ColumnSpec],
    source_name: str,
    target_name: str,
    folder: str,
    checkpoint: str,
    project: Callable[[DataFrame], DataFrame] = lambda df: df,
    across_runs: bool = False,
) -> None:
    """Check all new files of a run together; failures and passed rows go to `failed/` and `passed/` in the folder.

    The rows land in `rows/` batch by batch and are checked when the run has read everything, so neither the report
    nor its duplicate keys depend on how files were dealt to batches. What an interrupted run left unchecked is checked
    by the next one, into the same place: `checkpoint=<id>/from=<first batch>`. With `across_runs`, a key that an earlier
    run of this checkpoint has seen is a duplicate in all of its rows; the keys are kept in `seen/`.
    """
    spark = stream.sparkSession
    landed = ingest(stream, columns, f"{folder}/rows", checkpoint)
    own = landed.rsplit("/", 1)[-1]
    log = f"{folder}/checked/{own}"
    done = _read(spark, log)
    last = -1 if done is None else done.agg(F.max("last")).first()[0]
    rows = _read(spark, landed)
    if rows is None:
        return
    fresh = rows.where(F.col("batch") > last)
    newest = fresh.agg(F.max("batch")).first()[0]
    if newest is None:
        return
    fresh = project(fresh.drop("batch"))
    names = key_names(specs)
    seen, again = None, None
    if across_runs and names:
        seen = SeenKeys(spark, f"{folder}/seen/{own}", [fresh.schema[k] for k in names])
        found = scratch_path(spark, "keys")
        keys = fresh.where(all_present(names)).select(*names).distinct()
        keys.write.parquet(found)
        keys = spark.read.schema(keys.schema).parquet(found)
        again = seen.among(keys, last + 1)
    result = check(fresh, specs, source_name, target_name, again).staged()
    result.failed.write.mode("overwrite").parquet(f"{folder}/failed/{own}/from={last + 1}")
    result.passed_null_key.write.mode("overwrite").parquet(f"{folder}/passed/{own}/from={last + 1}")
    if seen is not None:
        seen.add(keys, last + 1)
    spark.range(1).select(F.lit(newest).cast("long").alias("last")).write.mode("append").parquet(log)


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet folder, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """A name that stays with the checkpoint folder."""
    path = f"{checkpoint}/folder-id"
    known = _read(spark, path)
    if known is None:
        spark.range(1).select(F.lit(uuid.uuid4().hex).alias("id")).write.parquet(path)
        known = _read(spark, path)
    return known.first()["id"]
