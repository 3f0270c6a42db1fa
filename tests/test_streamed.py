"""Data sources that stream files: the same rows as the readers over binary files, in tasks by file and by entry."""

import gzip

import pytest

from barsieve.sources import streamed
from barsieve.sources.archives import list_archives, scan_staged_entries, stage_entries, unzip_lines, unzip_rows
from barsieve.sources.snapshots import read_snapshots
from barsieve.sources.streamed import stream_archive_lines, stream_archive_rows, stream_snapshots
from tests.conftest import rows
from tests.test_archives import HEADER, A, _zip, archives  # noqa: F401
from tests.test_snapshots import _pack, _record, _write, staged  # noqa: F401


def test_records_are_those_of_the_binary_reader(spark, staged):  # noqa: F811
    for path in (str(staged), f"file:{staged}", f"file://{staged}"):
        streamed_rows = stream_snapshots(spark, path)
        assert streamed_rows.schema == read_snapshots(spark, str(staged)).schema
        assert rows(streamed_rows) == rows(read_snapshots(spark, str(staged)))
    assert stream_snapshots(spark, str(staged), "*.none").count() == 0


def test_files_make_tasks(spark, staged):  # noqa: F811
    assert stream_snapshots(spark, str(staged), task_bytes=1).rdd.getNumPartitions() == 4
    assert stream_snapshots(spark, str(staged)).rdd.getNumPartitions() == 1
    plan = stream_snapshots(spark, str(staged))._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan


def test_one_block_of_a_file_is_held(spark, tmp_path):
    """A file is read as it is decompressed: what a consumer has not asked for is not read."""
    _write(tmp_path / "August282023", "1.mkt.gz", gzip.compress(_pack(_record(1)) * 400_000))
    reader = streamed.SnapshotFiles({"path": str(tmp_path)}).reader(None)
    (part,) = reader.partitions()
    sizes = [batch.num_rows for batch in reader.read(part)]
    assert sum(sizes) == 400_000 and max(sizes) == 64 * 1024
    first = next(iter(reader.read(part)))
    assert first.num_rows == 64 * 1024


def test_damaged_files_fail(spark, staged):  # noqa: F811
    _write(staged / "August292023", "cut.mkt.gz", gzip.compress(_pack(_record(1)) * 3000)[:500])
    with pytest.raises(Exception, match="(?i)end-of-stream|EOF"):
        stream_snapshots(spark, str(staged)).count()


def test_entries_are_those_of_the_binary_reader(spark, archives, tmp_path):  # noqa: F811
    listed = list_archives(spark, str(archives))
    assert rows(stream_archive_rows(spark, str(archives))) == rows(unzip_rows(listed))
    lines = stream_archive_lines(spark, str(archives))
    strip = lambda df: rows(df.selectExpr("substring_index(archive, '/', -1)", "entry", "line_no", "line"))
    assert strip(lines) == strip(unzip_lines(listed))
    stage_entries(lines, str(tmp_path / "streamed"))
    assert rows(scan_staged_entries(spark, str(tmp_path / "streamed"), ["SYMBOL", "ISIN"]))[0] == ("AAA", "INA")


def test_an_archive_of_many_entries_uses_many_tasks(spark, tmp_path):
    _zip(tmp_path / "many.zip", {f"{i:02d}.csv": f"{HEADER}\n{A}\n" for i in range(40)})
    assert list_archives(spark, str(tmp_path)).rdd.getNumPartitions() == 1
    by_entry = stream_archive_rows(spark, str(tmp_path), task_bytes=1)
    assert by_entry.rdd.getNumPartitions() == 40
    assert sorted(r["entry"] for r in by_entry.collect()) == [f"{i:02d}.csv" for i in range(40)]
    assert stream_archive_rows(spark, str(tmp_path)).rdd.getNumPartitions() == 1


def test_absent_columns_fail(spark, tmp_path):
    _zip(tmp_path / "a.zip", {"a.csv": "SYMBOL,MORE\nAAA,1\n"})
    assert rows(stream_archive_rows(spark, str(tmp_path), ["MORE"])) == [("a.csv", "1")]
    with pytest.raises(Exception, match="no column ISIN in .*a.csv"):
        stream_archive_rows(spark, str(tmp_path), ["SYMBOL", "ISIN"]).collect()
