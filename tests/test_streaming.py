import pytest

from barsieve.functions.declared import column_specs
from barsieve.plans import views
from barsieve.streaming import ingest as ingest_module
from barsieve.streaming.ingest import ingest, ingest_checked, new_files
from barsieve.streaming.seen import SeenKeys
from tests.conftest import rows


def _deliver(folder, name, lines, head="k,v"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([head, *lines]) + "\n")


def test_files_are_read_once_and_archived(spark, tmp_path):
    incoming, archive = tmp_path / "incoming", tmp_path / "archive"

    def run():
        stream = new_files(spark, str(incoming), ["k", "v"], str(archive), files_per_batch=1)
        folder = ingest(stream, ["k", "v"], str(tmp_path / "table"), str(tmp_path / "progress"))
        return rows(spark.read.parquet(folder).select("k", "v"))

    _deliver(incoming, "a.csv", ["1,x"])
    _deliver(incoming, "b.csv", ["y,2,z"], "v,k,more")
    assert run() == [("1", "x"), ("2", "y")]
    assert run() == [("1", "x"), ("2", "y")]
    _deliver(incoming, "c.csv", ["3,z"])
    assert run() == [("1", "x"), ("2", "y"), ("3", "z")]
    moved = {p.name for p in archive.rglob("*.csv")}
    left = {p.name for p in incoming.rglob("*.csv")}
    assert "a.csv" in moved and moved | left == {"a.csv", "b.csv", "c.csv"} and not moved & left


def _checked(spark, tmp_path, files_per_batch=None, progress="progress", **options):
    metadata = views.metadata_frame(spark, [("k", "INT", None, True, True), ("v", "CHAR(1)", None, False, False)])
    specs = column_specs(metadata, ["k", "v"])
    stream = new_files(spark, str(tmp_path / "incoming"), ["k", "v"], files_per_batch=files_per_batch)
    ingest_checked(stream, ["k", "v"], specs, "s", "t", str(tmp_path / "out"), str(tmp_path / progress), **options)
    return spark.read.parquet(str(tmp_path / "out" / "passed")), spark.read.parquet(str(tmp_path / "out" / "failed"))


def test_runs_are_checked(spark, tmp_path):
    _deliver(tmp_path / "incoming", "a.csv", ["1,x", "1,y", ",z"])
    _checked(spark, tmp_path)
    _deliver(tmp_path / "incoming", "b.csv", ["2,long"])
    passed, failed = _checked(spark, tmp_path)
    assert rows(passed.select("k", "v", "from")) == [("1", "x", 0), ("1", "y", 0), ("2", "long", 1)]
    assert sorted((r["Validation Type"], r["from"]) for r in failed.collect()) == [
        ("DataLength - CHAR(1) Validation", 1),
        ("Primary Key - Duplicate Data Validation", 0),
        ("Primary Key - Null Data Validation", 0),
    ]
    again = _checked(spark, tmp_path)
    assert [x.count() for x in again] == [3, 3]


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_duplicates_are_found_across_files(spark, tmp_path, files_per_batch):
    _deliver(tmp_path / "incoming", "a.csv", ["1,x"])
    _deliver(tmp_path / "incoming", "b.csv", ["y,1"], "v,k")
    passed, failed = _checked(spark, tmp_path, files_per_batch)
    assert rows(passed.select("k", "v")) == [("1", "x"), ("1", "y")]
    assert [(r["Validation Type"], r["Unmatched Records"]) for r in failed.collect()] == [
        ("Primary Key - Duplicate Data Validation", "{k -> 1, v -> y}")
    ]


def test_a_new_checkpoint_replaces_nothing(spark, tmp_path):
    _deliver(tmp_path / "incoming", "a.csv", ["1,x"])
    _checked(spark, tmp_path)
    passed, _ = _checked(spark, tmp_path, progress="lost-and-new")
    assert rows(passed.select("k", "v")) == [("1", "x"), ("1", "x")]


def test_a_file_without_the_columns_fails(spark, tmp_path):
    _deliver(tmp_path / "incoming", "a.csv", ["1,x"], "k,w")
    with pytest.raises(Exception, match="no header with k, v"):
        _checked(spark, tmp_path)


def _duplicates(failed):
    kind = "Primary Key - Duplicate Data Validation"
    return sorted((r["Unmatched Records"], r["from"]) for r in failed.where(failed["Validation Type"] == kind).collect())


def test_duplicates_are_found_across_runs(spark, tmp_path):
    _deliver(tmp_path / "incoming", "a.csv", ["1,x", "2,y", "2,z", ",w"])
    _checked(spark, tmp_path, across_runs=True)
    _deliver(tmp_path / "incoming", "b.csv", ["1,a", "1,x", "3,b", "3,c", ",w"])
    _checked(spark, tmp_path, across_runs=True)
    _deliver(tmp_path / "incoming", "c.csv", ["3,d", "4,e"])
    passed, failed = _checked(spark, tmp_path, across_runs=True)
    want = [("{k -> 1, v -> a}", 1), ("{k -> 1, v -> x}", 1), ("{k -> 2, v -> z}", 0), ("{k -> 3, v -> c}", 1)]
    assert _duplicates(failed) == [*want, ("{k -> 3, v -> d}", 2)]
    assert passed.count() == 9


def test_an_interrupted_run_does_not_see_its_own_keys(spark, tmp_path, monkeypatch):
    _deliver(tmp_path / "incoming", "a.csv", ["1,x", "2,y"])
    real = SeenKeys.add

    def add_and_fail(self, keys, first):
        real(self, keys, first)
        raise OSError("lost")

    monkeypatch.setattr(ingest_module.SeenKeys, "add", add_and_fail)
    with pytest.raises(OSError, match="lost"):
        _checked(spark, tmp_path, across_runs=True)
    monkeypatch.setattr(ingest_module.SeenKeys, "add", real)
    _deliver(tmp_path / "incoming", "b.csv", ["2,y", "3,z"])
    _, failed = _checked(spark, tmp_path, across_runs=True)
    assert _duplicates(failed) == [("{k -> 2, v -> y}", 0)]
    _deliver(tmp_path / "incoming", "c.csv", ["3,z"])
    _, failed = _checked(spark, tmp_path, across_runs=True)
    assert _duplicates(failed) == [("{k -> 2, v -> y}", 0), ("{k -> 3, v -> z}", 2)]


def test_seen_keys_are_read_as_they_lie(spark, tmp_path, capsys):
    keys = spark.range(500).selectExpr("cast(id as string) as `k'1`", "id % 7 as n")
    seen = SeenKeys(spark, str(tmp_path / "it's"), list(keys.schema), buckets=16)
    seen.add(keys.where("cast(`k'1` as int) < 300"), 0)
    seen.add(keys.where("cast(`k'1` as int) >= 450"), 3)
    # defined anew, as in a new session, with another wish for buckets
    spark.sql(f"drop table {seen._table}")
    again = SeenKeys(spark, str(tmp_path / "it's"), list(keys.schema), buckets=5)
    assert again._buckets == 16
    assert [again.among(keys, before).count() for before in (0, 1, 4)] == [0, 300, 350]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        again.among(keys, 4).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
