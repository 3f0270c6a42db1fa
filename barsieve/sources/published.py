"""Several tables that belong together, published at once."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "turn bigint, version string"


def publish(spark: SparkSession, folder: str, tables: dict[str, DataFrame]) -> str:
    """Write the tables as a new version and, when all are there, name it in the folder's manifest; returns the version.

    Each version has a folder of its own, `version=<id>/<table>`, so readers of the last one are not disturbed. The
    manifest grows by one file of one row, which a store shows whole or not at all: a job that dies before leaves all
    tables as they were. Old versions are left for the owner of the folder to remove.
    """
    version = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{folder}/version={version}/{name}")
    last = _last(spark, folder)
    row = spark.range(1).select(
        F.lit(0 if last is None else last[0] + 1).cast("bigint").alias("turn"), F.lit(version).alias("version")
    )
    row.coalesce(1).write.mode("append").parquet(f"{folder}/manifest")
    return version


def read_published(spark: SparkSession, folder: str, table: str, version: str | None = None) -> DataFrame:
    """A table of the last version that the manifest names, or of a given one."""
    if version is None:
        last = _last(spark, folder)
        if last is None:
            raise FileNotFoundError(f"nothing is published in {folder}")
        version = last[1]
    return spark.read.parquet(f"{folder}/version={version}/{table}")


def _last(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """Turn and version of the newest row; of two jobs that took the same turn, one and the same wins for all readers."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    found = rows.orderBy(F.desc("turn"), F.desc("version")).first()
    return None if found is None else (found["turn"], found["version"])
