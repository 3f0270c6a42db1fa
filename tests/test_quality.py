import pytest
from pyspark.sql import functions as F

from barsieve.functions.declared import column_specs
from barsieve.operators.quality import Labels, check, null_key_failures
from barsieve.plans import queries, views
from barsieve.schemas import REPORT_COLUMNS
from tests.conftest import rows


def _specs(spark, metadata):
    return column_specs(views.metadata_frame(spark, metadata), [m[0] for m in metadata])


METADATA = [
    ("id", "VARCHAR(3)", None, True, True),
    ("day", "DATE", "'YYYY-MM-DD'", True, True),
    ("qty", "INT", None, False, True),
    ("px", "DECIMAL(4,1)", None, False, False),
    ("note", "TIMESTAMP", None, False, False),
]
DATA = [
    ("a", "2020-01-01", "1", "1.5", "ok"),
    ("a", "2020-01-01", "2", "1.5", "ok"),
    (None, None, "x", "y", "both null"),
    ("b", None, "1", "1.5", "no day"),
    ("abcd", "2020-01-02", None, "5", None),
    ("c&", "bad", "12345678901", "1.25", "n"),
]


def _result(spark):
    df = spark.createDataFrame(DATA, "id string, day string, qty string, px string, note string")
    return df, check(df, _specs(spark, METADATA), "src", "dst")


def test_report(spark):
    _, result = _result(spark)
    assert result.failed.columns == REPORT_COLUMNS
    got = sorted((r[0], r[4], r[5]) for r in result.failed.collect())
    key = "{id -> abcd, day -> 2020-01-02"
    odd = "{id -> c&, day -> bad"
    assert got == sorted(
        [
            ("Primary Key - Null Data Validation", "id", "{id -> null, day -> null, qty -> x, px -> y, note -> both null}"),
            ("Primary Key - Null Data Validation", "day", "{id -> b, day -> null, qty -> 1, px -> 1.5, note -> no day}"),
            (
                "Primary Key - Duplicate Data Validation",
                "id, day",
                "{id -> a, day -> 2020-01-01, qty -> 2, px -> 1.5, note -> ok}",
            ),
            ("DataLength - VARCHAR(3) Validation", "id", key + "}"),
            ("DataType - VARCHAR(3) Validation", "id", odd + "}"),
            ("DataLength - DATE Validation", "day", "**ALL RECORDS**"),
            ("Date Format Validation", "day", odd + "}"),
            ("DataLength - INT Validation", "qty", odd + ", qty -> 12345678901}"),
            ("DataType - INT Validation", "qty", key + ", qty -> null}"),
            ("DataType - DECIMAL(4,1) Validation", "px", key + ", px -> 5}"),
            ("DataLength - DECIMAL(4,1) Validation", "px", odd + ", px -> 1.25}"),
            ("DataLength - TIMESTAMP Validation", "note", "**ALL RECORDS**"),
            ("DataLength - TIMESTAMP Validation", "note", "**ALL RECORDS**"),
        ]
    )
    assert {tuple(r)[1:4] for r in result.failed.collect()} == {("src", "dst", "id, day")}


def test_passed(spark):
    df, result = _result(spark)
    assert rows(result.passed_null_key) == rows(df.where("id is not null and day is not null"))
    assert rows(result.passed_strict) == [DATA[0]]


def test_invariants(spark, sf_dir):
    dirty = views.dirty(spark, sf_dir)
    result = check(dirty, _specs(spark, queries.DIRTY_METADATA), "s", "t")
    by_kind = {r[0]: r[1] for r in result.failed.groupBy("Validation Type").count().collect()}
    total, passed = dirty.count(), result.passed_null_key.count()
    assert passed + by_kind["Primary Key - Null Data Validation"] == total
    distinct = result.passed_null_key.select("symbol", "d").distinct().count()
    assert by_kind["Primary Key - Duplicate Data Validation"] == passed - distinct
    assert result.failed.count() == sum(by_kind.values())
    assert result.passed_strict.exceptAll(result.passed_null_key).isEmpty()


def test_partitioning_does_not_matter(spark, sf_dir):
    specs = _specs(spark, queries.DIRTY_METADATA)
    found = []
    for parts in (1, 8):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        result = check(views.dirty(spark, sf_dir).repartition(parts), specs, "s", "t")
        found.append((rows(result.failed), rows(result.passed_strict)))
    assert found[0] == found[1]


def test_without_keys(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    result = check(df, _specs(spark, [("v", "INT", None, False, False)]), "s", "t")
    assert [tuple(r) for r in result.failed.collect()] == [("DataType - INT Validation", "s", "t", "", "v", "{v -> x}")]
    assert rows(result.passed_null_key) == rows(df)
    assert rows(result.passed_strict) == [("1",), (None,)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "id string, day string, qty string, px string, note string")
    result = check(df, _specs(spark, METADATA), "s", "t")
    assert [r[5] for r in result.failed.collect()] == ["**ALL RECORDS**"] * 3
    assert result.passed_strict.isEmpty()


def test_bare_types_skip_the_length_rule(spark):
    metadata = [("k", "VARCHAR", None, True, True), ("f", "FLOAT", None, False, False)]
    df = spark.createDataFrame([("abc", "1.25"), ("def", "7")], "k string, f string")
    result = check(df, _specs(spark, metadata), "s", "t")
    assert [(r[0], r[4]) for r in result.failed.collect()] == [("DataType - FLOAT Validation", "f")]


def test_undeclared_and_missing_columns(spark):
    df = spark.createDataFrame([("a",)], "other string")
    with pytest.raises(ValueError, match="not in the data"):
        check(df, _specs(spark, METADATA), "s", "t")
    more = spark.createDataFrame([("1", "2", "3")], "k string, v string, w string")
    with pytest.raises(ValueError, match="not declared: w"):
        check(more, _specs(spark, [("k", "INT", None, True, True), ("v", "INT", None, False, False)]), "s", "t")


def test_checks_stay_in_the_jvm(spark, sf_dir, tmp_path, capsys):
    path = str(tmp_path / "rows")
    views.dirty(spark, sf_dir).write.parquet(path)
    result = check(spark.read.parquet(path), _specs(spark, queries.DIRTY_METADATA), "s", "t")
    result.failed.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "ExistingRDD" not in plan and "Window" not in plan
    result.passed_null_key.explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_a_large_group_of_null_keys_is_spread(spark):
    df = spark.range(2000).selectExpr("cast(null as string) k", "cast(id as string) v")
    failed = check(df, _specs(spark, [("k", "INT", None, True, True), ("v", "INT", None, False, False)]), "s", "t").failed
    assert failed.count() == 2000
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        sizes = [len(p) for p in failed.rdd.glom().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert max(sizes) < 1000


def test_null_keys_are_reported_once(spark):
    df = spark.createDataFrame([(None, None), ("a", None), (None, "b"), ("a", "b")], "x string, y string")
    got = null_key_failures(df, Labels("s", "t", ("y", "x")))
    assert sorted(r[4] for r in got.collect()) == ["x", "y", "y"]
    assert got.where(F.col("Primary Key Field(s)") == "y, x").count() == 3


def test_key_order_comes_from_the_metadata(spark):
    df = spark.createDataFrame([(None, None, "1"), ("a", "b", "x")], "p string, q string, n string")
    metadata = views.metadata_frame(
        spark, [("q", "CHAR(1)", None, True, True), ("n", "INT", None, False, False), ("p", "CHAR(1)", None, True, True)]
    )
    got = sorted(tuple(r)[3:] for r in check(df, column_specs(metadata, df.columns), "s", "t").failed.collect())
    assert got == [("q, p", "n", "{q -> b, p -> a, n -> x}"), ("q, p", "q", "{p -> null, q -> null, n -> 1}")]


def test_staged_result_is_the_same(spark, sf_dir, tmp_path):
    df = views.dirty(spark, sf_dir)
    for metadata in (queries.DIRTY_METADATA, queries.ODD_METADATA):
        plain = check(df, _specs(spark, metadata), "s", "t")
        staged = plain.staged(str(tmp_path / metadata[0][1]))
        for part in ("failed", "passed_null_key", "passed_strict"):
            assert rows(getattr(staged, part)) == rows(getattr(plain, part)), part
            assert getattr(staged, part).columns == getattr(plain, part).columns


def test_staged_result_reads_the_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df, _ = _result(spark)
    staged = check(df.mapInArrow(count, df.schema), _specs(spark, METADATA), "s", "t").staged(str(tmp_path / "staged"))
    assert seen.value == len(DATA)
    for part in (staged.failed, staged.passed_null_key, staged.passed_strict):
        part.collect()
    assert seen.value == len(DATA)


def test_rules_stand_once_in_the_strict_plan(spark, sf_dir):
    """With filters on rules that can be pushed through a join, the plan of a wide table took longer than its rows."""
    bars = views.staged_bars(spark, sf_dir).drop("trade_date").withColumnRenamed("TIMESTAMP", "generated_date")
    plan = check(bars, _specs(spark, queries.BAR_METADATA), "s", "t").passed_strict._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("exists(") == 1 and "Join" not in plan.split("Aggregate")[0]
