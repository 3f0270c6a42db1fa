"""Shared pieces of the corpus operators: staging, text blocks for Arrow functions, null-safe sources."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barsieve.scratch import scratch_path

#: Java and Python pattern of one word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a task turns into arrays at a time. A longer text makes a block of its own.
BLOCK_BYTES = 2 << 20

#: Bytes of rows that Spark hands to a Python worker at a time; its default of 64 MB is held several times over.
BATCH_BYTES = 8 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def importable(spark: SparkSession) -> None:
    """Let workers on this machine import the package from where the driver has it.

    On a cluster it goes along with the job (`--py-files`), like any package.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def small_batches(spark: SparkSession) -> None:
    """Hand Python workers at most `BATCH_BYTES` of rows at a time, unless the session has a size of its own."""
    if spark.conf.get(_BATCH_SETTING, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lowered(column: Column) -> Column:
    """Lower case for A-Z only, whatever the locale."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `limit` bytes of text each, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start, done = 0, 0
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            done, start = int(ends[stop - 1]), stop


def _as_arrow(values: object, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def add_columns(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], dict[str, object]],
    added: str,
    keep: list[str] | None = None,
    column: str = "text",
    uses: tuple[str, ...] = (),
) -> DataFrame:
    """All rows with the columns `keep` (None: all) and new ones that a function gives for a block of rows.

    The function sees the text column, the kept columns and those in `uses`. An input column with the name of a new
    one is replaced.
    """
    extra = StructType.fromDDL(added)
    new = {f.name.lower() for f in extra}
    held = [f for f in df.schema if (keep is None or f.name in keep) and f.name.lower() not in new]
    out = StructType(held + list(extra.fields))
    arrow = to_arrow_schema(out)
    names = [f.name for f in held]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, column):
            made = function(block)
            columns = [block.column(n).cast(arrow.field(n).type) for n in names]
            columns += [_as_arrow(made[f.name], arrow.field(f.name).type) for f in extra]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    used = df.select([c for c in df.columns if c in names or c in (column, *uses)])
    return used.mapInArrow(run, out)


def map_blocks(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], dict[str, object]],
    schema: str,
    column: str = "text",
) -> DataFrame:
    """Rows that a function makes of each text block, as columns by name."""
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, column):
            made = function(block)
            yield pa.RecordBatch.from_arrays([_as_arrow(made[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows that come sorted by integer keys: tables, each with the cuts between its groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        values = np.column_stack([table.column(k).to_numpy() for k in keys])
        cuts = np.concatenate([[0], np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1])
        if cuts[-1]:
            yield table.slice(0, cuts[-1]), cuts
        held = table.slice(cuts[-1]).to_batches()  # its last group may go on
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.array([0, table.num_rows])
