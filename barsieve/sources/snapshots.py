"""Intraday snapshot files: gzip of fixed-width binary records."""

from __future__ import annotations

import gzip
import io
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsieve.functions.days import day_in_path, file_in_path
from barsieve.schemas import SNAPSHOT_BYTES, SNAPSHOT_FIELDS, SNAPSHOT_SCHEMA

# the functions that tasks run travel with the job, so executors need no copy of this package
register_pickle_by_value(sys.modules[__name__])

RECORDS_PER_BATCH = 64 * 1024

#: A record's fields, then its day and file.
RECORD_SCHEMA = T.StructType(
    [*SNAPSHOT_SCHEMA.fields, T.StructField("trade_date", T.DateType()), T.StructField("source_file", T.StringType())]
)

_UNREADABLE = (OSError, EOFError, zlib.error)


def list_files(spark: SparkSession, path: str, name_filter: str = "*.mkt.gz*") -> DataFrame:
    """Path, trade date and size of the files whose name matches; the files are not opened.

    Spark leaves files of zero bytes out of a scan, so they are not listed either.
    """
    files = _files(spark, path, name_filter).select("path", "length")
    return files.select("path", day_in_path(F.col("path")).alias("trade_date"), "length")


def read_snapshots(spark: SparkSession, path: str, name_filter: str = "*.mkt.gz*") -> DataFrame:
    """All records of the snapshot files below a folder, with the file they come from and its trading day.

    Spark packs files into tasks of spark.sql.files.maxPartitionBytes; a gzip file cannot be split, so one
    file is always one task.
    """
    return decode_snapshots(_files(spark, path, name_filter).select("path", "content"))


def decode_snapshots(files: DataFrame) -> DataFrame:
    """Records of files given as `path` and gzip `content`; a short record at the end is dropped.

    A file that is no whole gzip file fails the job; `unreadable_files` names such files.
    """
    origin = RECORD_SCHEMA.names[-2:]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                content = batch.column("content")[row].as_buffer()
                for block in _blocks(content):
                    columns = record_columns(block)
                    same = pa.array(np.full(len(columns[0]), row, dtype="i4"))
                    columns += [batch.column(c).take(same) for c in origin]
                    yield pa.RecordBatch.from_arrays(columns, names=RECORD_SCHEMA.names)

    # day and file name are worked out per file, not per record
    path = F.col("path")
    named = files.select("content", day_in_path(path).alias("trade_date"), file_in_path(path).alias("source_file"))
    return named.mapInArrow(decode, RECORD_SCHEMA)


def record_columns(block: bytes) -> list[pa.Array]:
    """The fields of whole records."""
    layout = np.dtype([(n, f"<u{size}") for n, size in SNAPSHOT_FIELDS] + [("unused", "<u4"), ("pad", "V16")])
    records = np.frombuffer(block, dtype=layout)
    return [pa.array(records[n].astype(f"i{size * 2}")) for n, size in SNAPSHOT_FIELDS]


def unreadable_files(files: DataFrame) -> DataFrame:
    """Files given as `path` and `content` that are no whole gzip file, with the reason."""

    def inspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, content in _each_file(batches):
            problem = _problem(content)
            if problem is not None:
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([problem])], names=["path", "reason"])

    return files.select("path", "content").mapInArrow(inspect, "path string, reason string")


def _files(spark: SparkSession, path: str, name_filter: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name_filter)
        .option("recursiveFileLookup", True)
        .load(path)
    )


def _each_file(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Buffer]]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            yield path.as_py(), content.as_buffer()


def _blocks(content: pa.Buffer) -> Iterator[bytes]:
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as stream:
        yield from record_blocks(stream)


def record_blocks(stream: gzip.GzipFile) -> Iterator[bytes]:
    """The decompressed file in blocks of whole records; at most one block is held at a time."""
    size = SNAPSHOT_BYTES * RECORDS_PER_BATCH
    while block := stream.read(size):
        whole = len(block) - len(block) % SNAPSHOT_BYTES
        if whole:
            yield block[:whole]


def _problem(content: pa.Buffer) -> str | None:
    try:
        for _ in _blocks(content):
            pass
    except _UNREADABLE as error:
        return f"{type(error).__name__}: {error}"
    return None
