"""Daily bar archives: zip files with CSV entries."""

from __future__ import annotations

import csv
import io
import sys
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsieve.functions.days import file_in_path
from barsieve.schemas import STAGED_BAR_COLUMNS
from barsieve.sources.csv import SPARE_COLUMNS, cell_schema, read_by_name

# the functions that tasks run travel with the job, so executors need no copy of this package
register_pickle_by_value(sys.modules[__name__])

_READ_BYTES = 1 << 20


def list_archives(spark: SparkSession, path: str, name_filter: str = "*.zip*") -> DataFrame:
    """Path and content of the archives below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", name_filter)
    return files.option("recursiveFileLookup", True).load(path).select("path", "content")


def unzip_rows(archives: DataFrame, columns: list[str] = STAGED_BAR_COLUMNS) -> DataFrame:
    """Rows of every CSV entry, all text, columns matched by header; an empty field is null.

    An entry whose header lacks a column, or has it beyond the `SPARE_COLUMNS` further cells that are parsed, fails the
    job; further columns are left out, and an entry without a line has no rows. Lines are parsed by Spark as those of
    any CSV file.
    """
    return parsed_lines(_lines(archives, list(columns)), list(columns))


def parsed_lines(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the lines that follow the header of each entry."""
    schema = cell_schema(len(columns) + SPARE_COLUMNS)
    parsed = F.from_csv("line", schema.simpleString()[7:-1].replace(":", " "))
    # out of a generator, so that a line is parsed once and not for each of its cells
    found = as_text(lines).where("line_no > 0").select("entry", "places", F.explode(F.array(parsed)).alias("c"))
    found = found.select("entry", "places", F.array(*[F.col("c")[f.name] for f in schema]).alias("cells"))
    at = [F.get("cells", F.get("places", F.lit(i))).alias(c) for i, c in enumerate(columns)]
    return found.select("entry", *at)


def unzip_lines(archives: DataFrame) -> DataFrame:
    """Lines of every entry with their archive and position, for staging the entries as they are."""
    return as_text(_lines(archives, [])).drop("places")


LINES = "archive string, entry string, line_no bigint, line binary, places array<int>"


def _lines(archives: DataFrame, columns: list[str]) -> DataFrame:
    """Lines of every entry: `archive`, `entry`, `line_no`, `line`, and where its header has the columns: `places`."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, name, stream in _entries(batches):
            yield from line_batches(path, name, stream, columns)

    return archives.select("path", "content").mapInArrow(lines, LINES)


def line_batches(path: str, name: str, stream: zipfile.ZipExtFile, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The lines of one entry, a block at a time."""
    start, places = 0, None
    while block := stream.readlines(_READ_BYTES):
        if places is None:
            places = _places(block[0], columns, f"{path} {name}")
        n = len(block)
        same = pa.array([0] * n, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([path]).take(same),
                pa.array([name]).take(same),
                pa.array(range(start, start + n), pa.int64()),
                pa.array([line.removesuffix(b"\n").removesuffix(b"\r") for line in block], pa.binary()),
                pa.array([places], pa.list_(pa.int32())).take(same),
            ],
            names=["archive", "entry", "line_no", "line", "places"],
        )
        start += n


def as_text(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line", F.col("line").cast("string"))


def _places(header: bytes, columns: list[str], where: str) -> list[int]:
    """Where a header line has the columns."""
    names = next(csv.reader([header.decode("utf-8-sig").rstrip("\r\n")]), [])
    absent = [c for c in columns if c not in names]
    if absent:
        raise ValueError(f"no column {', '.join(absent)} in {where}")
    places = [names.index(c) for c in columns]
    beyond = [c for c, k in zip(columns, places, strict=True) if k >= len(columns) + SPARE_COLUMNS]
    if beyond:
        raise ValueError(f"column {', '.join(beyond)} beyond {len(columns) + SPARE_COLUMNS} cells in {where}")
    return places


def stage_entries(archives: DataFrame, path: str) -> None:
    """Write every entry line by line under its archive's and its own name; no shuffle, one file per entry.

    `archives` are those listed with their content, or the lines of their entries as a stream gives them.

    `archive=<name>-<hash of its path>/entry=<name>/`, so that entries of one name in several archives stay apart, and
    so do archives of one name in several folders.
    """
    source = F.col("archive")
    own = F.concat(file_in_path(source), F.lit("-"), F.hex(F.xxhash64(source)))
    lines = unzip_lines(archives) if "content" in archives.columns else archives
    named = lines.withColumn("archive", own)
    ordered = named.sortWithinPartitions("archive", "entry", "line_no")
    ordered.select("archive", "entry", "line").write.partitionBy("archive", "entry").mode("overwrite").text(path)


def scan_staged_entries(
    spark: SparkSession, path: str, columns: list[str] = STAGED_BAR_COLUMNS, stage: str | None = None
) -> DataFrame:
    """The staged entries as one CSV scan, all text, columns by name."""
    return read_by_name(spark, path, list(columns), stage=stage, recursiveFileLookup=True)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, zipfile.ZipExtFile]]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as archive:
                for info in archive.infolist():
                    if not info.is_dir():
                        with archive.open(info) as stream:
                            yield path.as_py(), info.filename, stream
