"""Tables published together, and counts taken while writing."""

import pytest
from pyspark.sql import functions as F

from barsieve.operators.reconcile import row_counts, written_counts
from barsieve.plans import views
from barsieve.plans.datasets import Dataset, run_dataset
from barsieve.sources.published import publish, read_published
from tests.conftest import rows

METADATA = [("k", "INT", None, True, True), ("v", "CHAR(1)", None, False, False)]


def _run(spark, folder, data):
    path = f"{folder}/metadata/t.csv"
    views.metadata_frame(spark, METADATA).write.mode("overwrite").option("header", True).csv(path)
    read = lambda s: s.createDataFrame(data, "k string, v string")
    run_dataset(spark, Dataset("t", "t.csv", read, "s", "t", folder=f"{folder}/checked"), path)


def _read(spark, folder):
    failed = read_published(spark, f"{folder}/checked", "failed").select("Unmatched Records")
    return rows(failed), rows(read_published(spark, f"{folder}/checked", "passed"))


def test_both_results_are_published(spark, tmp_path):
    _run(spark, tmp_path, [("1", "x"), ("x", "y"), (None, "z")])
    first = _read(spark, tmp_path)
    assert first == ([("{k -> null, v -> z}",), ("{k -> x}",)], [("1", "x"), ("x", "y")])
    _run(spark, tmp_path, [("2", "long")])
    assert _read(spark, tmp_path) == ([("{k -> 2, v -> long}",)], [("2", "long")])


def test_a_job_that_dies_between_leaves_the_old_pair(spark, tmp_path):
    _run(spark, tmp_path, [("1", "x"), (None, "z")])
    before = _read(spark, tmp_path)
    breaks = F.when(F.col("k") == "2", F.raise_error(F.lit("died"))).otherwise(F.col("k"))
    good, bad = (spark.createDataFrame([("2", "y")], "k string, v string") for _ in range(2))
    with pytest.raises(Exception, match="died"):
        publish(spark, f"{tmp_path}/checked", {"failed": good, "passed": bad.withColumn("k", breaks)})
    assert len(list((tmp_path / "checked").glob("version=*"))) == 2
    assert _read(spark, tmp_path) == before
    _run(spark, tmp_path, [("3", "y")])
    assert _read(spark, tmp_path) == ([], [("3", "y")])


def test_versions(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing is published"):
        read_published(spark, str(tmp_path / "none"), "t")
    versions = [publish(spark, str(tmp_path), {"t": spark.range(n)}) for n in (1, 2, 3)]
    assert read_published(spark, str(tmp_path), "t").count() == 3
    assert read_published(spark, str(tmp_path), "t", versions[0]).count() == 1


def test_counts_are_taken_while_writing(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.range(1000, numPartitions=7).mapInArrow(count, "id long")
    path = str(tmp_path / "t")
    found = written_counts(source, F.col("id") % 3 == 0, lambda df: df.write.parquet(path))
    assert seen.value == 1000
    assert rows(found) == rows(row_counts(spark.range(1000), spark.read.parquet(path)))
    assert rows(found) == [(1000, 334, 666, "rows that the target lacks: 666")] and seen.value == 1000
    empty = written_counts(spark.range(0), F.lit(True), lambda df: df.write.parquet(str(tmp_path / "empty")))
    assert rows(empty) == [(0, 0, 0, "both have as many rows")]
