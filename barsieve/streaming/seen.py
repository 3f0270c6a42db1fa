"""Keys that earlier runs have seen, kept in a bucketed table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FROM = "_from_batch"
#: Fewest buckets of a new table.
LEAST_BUCKETS = 64


class SeenKeys:
    """The distinct keys of every run, each with the first batch of its run, in buckets by key.

    A run joins its own keys to them; the table is read bucket by bucket, as it lies, so only the run's keys are shuffled,
    however many have been seen. The number of buckets belongs to the folder and is that of shuffle partitions
    when it was made, or `LEAST_BUCKETS` if that is more. The table is defined in the session's catalog over the folder,
    so a new session finds it there.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[T.StructField], buckets: int | None = None) -> None:
        self._spark = spark
        self._keys = [k.name for k in keys]
        wanted = buckets or max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self._buckets = self._fixed(f"{folder}/buckets", wanted)
        self._table = f"seen_keys_{hashlib.md5(folder.encode()).hexdigest()}"
        columns = ", ".join(f"{_quoted(k.name)} {k.dataType.simpleString()}" for k in keys)
        by = ", ".join(map(_quoted, self._keys))
        location = f"{folder}/keys".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"create table if not exists {self._table} ({columns}, {_FROM} bigint) using parquet "
            f"clustered by ({by}) into {self._buckets} buckets location '{location}'"
        )

    def among(self, keys: DataFrame, before: int) -> DataFrame:
        """Those of the distinct keys that a run whose first batch came before has seen."""
        self._spark.catalog.refreshTable(self._table)
        seen = self._spark.table(self._table).where(F.col(_FROM) < before).select(*self._keys)
        return keys.join(seen, self._keys, "left_semi")

    def add(self, keys: DataFrame, first: int) -> None:
        """Add the distinct keys of the run whose first batch is given.

        A run that was interrupted adds them again; it does not look at its own, and others take them as one.
        """
        dealt = keys.select(*self._keys, F.lit(first).cast("bigint").alias(_FROM)).repartition(self._buckets, *self._keys)
        dealt.write.insertInto(self._table)

    def _fixed(self, path: str, buckets: int) -> int:
        """The number of buckets of the folder; the first caller's."""
        made = self._spark.range(1).select(F.lit(buckets).alias("buckets"))
        made.write.mode("ignore").parquet(path)
        return self._spark.read.schema("buckets int").parquet(path).first()["buckets"]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
