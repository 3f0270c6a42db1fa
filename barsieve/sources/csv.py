"""CSV files as staged: a header row, every column text unless asked otherwise, columns found by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsieve.functions.days import day_in_path, file_in_path, named_folder_in_path
from barsieve.schemas import METADATA_COLUMNS, strings
from barsieve.scratch import scratch_path

#: Columns that a file may have beyond those asked for.
SPARE_COLUMNS = 32

FILE, _CELLS = "_file", "_cells"

#: Reader options that choose files; others say how lines are parsed.
_LISTING = ("recursiveFileLookup", "pathGlobFilter", "modifiedBefore", "modifiedAfter")


def cell_schema(width: int) -> T.StructType:
    """Cells of a line by place."""
    return strings([f"_c{i}" for i in range(width)])


def cells(columns: DataFrame | list[str]) -> Column:
    names = columns.columns if isinstance(columns, DataFrame) else columns
    return F.array(*[F.col(c) for c in names if c.startswith("_c")])


def headers(spark: SparkSession, files: str, columns: list[str], width: int, **options: object) -> DataFrame:
    """A row for each file: `_header_file`, and at which cells of its header the columns stand: `_places`.

    The header is the line that holds all the names. Lines are looked through as text; only those in which every name
    occurs are parsed.
    """
    listing = {k: v for k, v in options.items() if k in _LISTING}
    lines = spark.read.options(**listing).text(files).select("value", F.col("_metadata.file_path").alias(FILE))
    for c in columns:
        if '"' not in c:  # such a name is written in another way
            lines = lines.where(F.col("value").contains(c))
    parsing = {k: str(v) for k, v in options.items() if k not in _LISTING}
    schema = cell_schema(width)
    parsed = F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), parsing)
    # out of a generator, so that a line is parsed once and not for each of its cells
    found = lines.select(FILE, F.explode(F.array(parsed)).alias("line"))
    return _places(found.select(F.array(*[f"line.{c}" for c in schema.names]).alias(_CELLS), FILE), columns)


def _named(columns: list[str]) -> Column:
    """True for a line of cells that holds all the names; most are told by the first of them."""
    names = F.array(*[F.lit(c) for c in columns])
    named = F.array_contains(_CELLS, columns[0]) & (F.size(F.array_intersect(_CELLS, names)) == len(set(columns)))
    return F.coalesce(named, F.lit(False))


def _places(lines: DataFrame, columns: list[str]) -> DataFrame:
    places = F.array(*[F.array_position(_CELLS, c).cast("int") for c in columns])
    found = lines.where(_named(columns)).groupBy(F.col(FILE).alias("_header_file"))
    return found.agg(F.min(places).alias("_places"))


def by_header(lines: DataFrame, columns: list[str], headers: DataFrame | None = None) -> DataFrame:
    """Columns by name from cells by place (`_c0`, ...) and the file that they come from (`_file`).

    A file's header is the line that holds all the names; further columns are left out, and names may stand in any
    order, which may differ from file to file. A file without such a line fails the job when it is read. Without
    `headers` they are looked for in the lines, which are then gone through twice. A row for each file is joined by file.
    """
    lines = lines.select(cells(lines).alias(_CELLS), FILE)
    found = _places(lines, columns) if headers is None else headers
    rows = lines.where(~_named(columns)).join(found, F.col(FILE) == F.col("_header_file"), "left")
    absent = F.concat(F.lit(f"no header with {', '.join(columns)} in "), F.col(FILE))
    places = F.when(F.col("_places").isNull(), F.raise_error(absent).cast("array<int>")).otherwise(F.col("_places"))
    rows = rows.select(FILE, _CELLS, places.alias("_places"))
    at = [F.element_at(_CELLS, F.element_at("_places", i + 1)).alias(c) for i, c in enumerate(columns)]
    return rows.select(*at, FILE)


def scan_csv(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    nested: bool = False,
    infer: bool = False,
    source_file: bool = False,
    stage: str | None = None,
    staged: bool = True,
) -> DataFrame:
    """The CSV files of a folder, or of its direct sub-folders when `nested`, with the given columns by name.

    Without `columns` the names are those of the first file's header. A file that lacks one of them fails the job;
    further columns are left out. A first pass over the lines finds the files' headers; then the files are parsed once,
    when this is called, and their rows staged by name as Parquet (in `stage` or the shared folder), so what follows may
    read them as often as it needs, column by column. With `staged=False` nothing is written, and the files are
    parsed whenever the rows are read: for callers that write them once themselves. `infer` costs an extra pass over
    the files to guess the types. `source_file` adds the file of each row and the trading day that its path names.
    """
    files = f"{path.rstrip('/')}/{'*/' if nested else ''}*.csv"
    return read_by_name(spark, files, columns, infer, source_file, stage, staged)


def read_by_name(
    spark: SparkSession,
    files: str,
    columns: list[str] | None = None,
    infer: bool = False,
    source_file: bool = False,
    stage: str | None = None,
    staged: bool = True,
    **options: object,
) -> DataFrame:
    """`scan_csv` of files given by pattern and reader options."""
    reader = spark.read.option("header", True).options(**options)
    first = reader.option("inferSchema", infer).csv(files).schema if columns is None or infer else None
    names = list(columns if columns is not None else first.names)
    width = max(len(names), len(first or ())) + SPARE_COLUMNS
    found = spark.read.schema(cell_schema(width)).options(**options).csv(files)
    lines = found.select("*", F.col("_metadata.file_path").alias(FILE))
    rows = by_header(lines, names, headers(spark, files, names, width, **options))
    if infer:
        rows = rows.withColumns({c: F.col(c).try_cast(first[c].dataType) for c in names if c in first.names})
    rows = with_source_file(rows) if source_file else rows.drop(FILE)
    if not staged:
        return rows
    stage = stage or scratch_path(spark, "csv")
    rows.write.parquet(stage)
    return spark.read.schema(rows.schema).parquet(stage)


def with_source_file(rows: DataFrame) -> DataFrame:
    """In place of the path of each row's file, its name and the trading day that a folder of the path names.

    Files staged below folders `source_file=<name>` have that name.
    """
    path = F.col(FILE)
    name = F.coalesce(named_folder_in_path(path, "source_file"), file_in_path(path))
    return rows.withColumns({"source_file": name, "trade_date": day_in_path(path)}).drop(FILE)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A metadata file with its 14 columns under their fixed names, whatever its header says."""
    return spark.read.option("header", True).csv(path).toDF(*METADATA_COLUMNS)
