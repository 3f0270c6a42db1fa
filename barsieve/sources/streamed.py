"""Snapshot files and bar archives as Spark data sources that stream: partitions are planned by file or by zip entry.

Tasks open the files themselves, through the file systems that Arrow knows (local, S3, GCS, HDFS), and hold one block of a
file at a time, so files may be of any size. For other stores there are the readers over Spark's own binary files in
`snapshots` and `archives`, which take files of up to 2 GB.
"""

from __future__ import annotations

import datetime
import fnmatch
import gzip
import re
import sys
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from barsieve.functions.days import DAY_FOLDER_REGEX
from barsieve.schemas import STAGED_BAR_COLUMNS
from barsieve.sources import archives, snapshots

# the classes that tasks use travel with the job, so executors need no copy of this package
register_pickle_by_value(sys.modules[__name__])

#: Bytes of small files or entries that one task reads; a larger one is a task of its own.
TASK_BYTES = 32 << 20
#: Archives whose directories the driver reads at a time.
DIRECTORY_THREADS = 16


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _scheme(path: str) -> str:
    return path.split("://", 1)[0] + "://" if "://" in path else "file:" if path.startswith("file:") else ""


def found_files(path: str, name_filter: str) -> list[tuple[str, int]]:
    """Paths and sizes of the files below a folder whose name matches; as in Spark's scans, hidden and empty ones are not."""
    system, root = _opened(path)
    files = []
    for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
        below = info.path[len(root) :].strip("/").split("/")
        hidden = any(part[0] in "_." and "=" not in part for part in below)
        if info.type == fs.FileType.File and info.size and not hidden and fnmatch.fnmatchcase(info.base_name, name_filter):
            files.append((f"{_scheme(path)}{info.path}", info.size))
    return sorted(files)


@dataclass
class _Part(InputPartition):
    """What one task reads: paths of files, or of archives with an entry each."""

    items: list[tuple[str, str | None]]


def _dealt(items: list[tuple[tuple[str, str | None], int]], limit: int) -> list[_Part]:
    """Neighbouring items together up to a limit of bytes."""
    parts: list[_Part] = []
    size = limit
    for item, n in items:
        if size + n > limit:
            parts.append(_Part([]))
            size = 0
        parts[-1].items.append(item)
        size += n
    return parts or [_Part([])]  # without partitions Spark would read one that is None


def _day(path: str) -> datetime.date | None:
    """The trading day that a folder of the path names."""
    found = re.search("/(?:[^/=]+=)?" + DAY_FOLDER_REGEX + "/", path)
    try:
        return datetime.datetime.strptime(found[1], "%B%d%Y").date() if found else None
    except ValueError:
        return None


class _Files(DataSourceReader):
    def __init__(self, options: dict[str, str], default_filter: str) -> None:
        self.path = options["path"]
        self.name_filter = options.get("pathglobfilter", default_filter)
        self.limit = int(options.get("taskbytes", TASK_BYTES))


class _SnapshotReader(_Files):
    def partitions(self) -> list[InputPartition]:
        return _dealt([((path, None), size) for path, size in found_files(self.path, self.name_filter)], self.limit)

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        for path, _ in partition.items:
            system, inner = _opened(path)
            day, name = _day(path), path.rsplit("/", 1)[-1]
            with system.open_input_stream(inner, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for block in snapshots.record_blocks(stream):
                    columns = snapshots.record_columns(block)
                    n = len(columns[0])
                    origin = [pa.repeat(pa.scalar(day, pa.date32()), n), pa.repeat(pa.scalar(name), n)]
                    yield pa.RecordBatch.from_arrays([*columns, *origin], names=snapshots.RECORD_SCHEMA.names)


class SnapshotFiles(DataSource):
    """The records of gzip files of 78-byte records; a file is one task's stream."""

    @classmethod
    def name(cls) -> str:
        return "snapshot_files"

    def schema(self) -> T.StructType:
        return snapshots.RECORD_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _SnapshotReader({k.lower(): v for k, v in self.options.items()}, "*.mkt.gz*")


class _EntryReader(_Files):
    def __init__(self, options: dict[str, str]) -> None:
        super().__init__(options, "*.zip*")
        self.columns = [c for c in options.get("columns", "").split("\t") if c]

    def partitions(self) -> list[InputPartition]:
        """From the archives' directories, at their ends, which are all that is read here."""

        def entries(found: tuple[str, int]) -> list[tuple[tuple[str, str | None], int]]:
            system, inner = _opened(found[0])
            with system.open_input_file(inner) as file, zipfile.ZipFile(file) as archive:
                return [((found[0], i.filename), i.compress_size) for i in archive.infolist() if not i.is_dir()]

        with ThreadPoolExecutor(DIRECTORY_THREADS) as pool:
            listed = list(pool.map(entries, found_files(self.path, self.name_filter)))
        return _dealt([e for each in listed for e in each], self.limit)

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        for path, entry in partition.items:
            system, inner = _opened(path)
            with system.open_input_file(inner) as file, zipfile.ZipFile(file) as archive:
                with archive.open(entry) as stream:
                    yield from archives.line_batches(path, entry, stream, self.columns)


class ArchiveEntries(DataSource):
    """The lines of the entries of zip files; an entry is one task's stream, small ones share a task."""

    @classmethod
    def name(cls) -> str:
        return "archive_entries"

    def schema(self) -> str:
        return archives.LINES

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _EntryReader({k.lower(): v for k, v in self.options.items()})


def stream_snapshots(
    spark: SparkSession, path: str, name_filter: str = "*.mkt.gz*", task_bytes: int = TASK_BYTES
) -> DataFrame:
    """`read_snapshots` without a limit to the size of files."""
    spark.dataSource.register(SnapshotFiles)
    reader = spark.read.format(SnapshotFiles.name()).option("pathGlobFilter", name_filter)
    return reader.option("taskBytes", task_bytes).load(path)


def stream_archive_rows(
    spark: SparkSession,
    path: str,
    columns: list[str] = STAGED_BAR_COLUMNS,
    name_filter: str = "*.zip*",
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """`unzip_rows` of the archives below a folder, with tasks by entry instead of by archive."""
    return archives.parsed_lines(_entry_lines(spark, path, list(columns), name_filter, task_bytes), list(columns))


def stream_archive_lines(
    spark: SparkSession, path: str, name_filter: str = "*.zip*", task_bytes: int = TASK_BYTES
) -> DataFrame:
    """`unzip_lines` of the archives below a folder, for staging the entries as they are."""
    return archives.as_text(_entry_lines(spark, path, [], name_filter, task_bytes)).drop("places")


def _entry_lines(spark: SparkSession, path: str, columns: list[str], name_filter: str, task_bytes: int) -> DataFrame:
    spark.dataSource.register(ArchiveEntries)
    reader = spark.read.format(ArchiveEntries.name()).option("pathGlobFilter", name_filter)
    return reader.option("taskBytes", task_bytes).option("columns", "\t".join(columns)).load(path)
