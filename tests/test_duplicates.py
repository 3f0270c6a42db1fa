import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barsieve.operators.duplicates import except_all, first_rows, keep_first, mark_surplus, repeat_rows, surplus_rows
from tests.conftest import rows


def _skewed(spark, seed, n=3000):
    """A third of the rows share one key, another part of them are exact copies; nulls in all columns."""
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.33:
            key, value = "hot", rng.choice(["a", "b", None])
        elif kind < 0.5:
            key, value = "copies", "same"
        else:
            key, value = rng.choice([None, *[f"k{i}" for i in range(200)]]), rng.choice(["x", "y", None, "z"])
        data.append((value, key, rng.choice([1, 2, None])))
    return spark.createDataFrame(data, "v string, k string, n int").repartition(6), data


def _nulls_first(row):
    return tuple((x is not None, x) for x in row)


def _survivors(data, keyed):
    best = {}
    for row in data:
        key, rest = row[1], (row[0], row[2])
        if key not in best or _nulls_first(rest) < _nulls_first(best[key]):
            best[key] = rest
    return Counter((rest[0], key, rest[1]) for key, rest in best.items())


def test_surplus_matches_brute_force(spark):
    df, data = _skewed(spark, 7)
    marked = mark_surplus(df, ["k"]).collect()
    kept = Counter(tuple(r)[:3] for r in marked if not r["_surplus"])
    surplus = Counter(tuple(r)[:3] for r in marked if r["_surplus"])
    assert kept == _survivors(data, "k")
    assert kept + surplus == Counter(data)


def test_keep_first_matches_brute_force(spark):
    df, data = _skewed(spark, 11)
    assert Counter(tuple(r) for r in keep_first(df, ["k"]).collect()) == _survivors(data, "k")


def test_keys_only_rows(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("b", 2)], "k string, n int")
    assert rows(mark_surplus(df, ["k", "n"]).where("_surplus").select("k", "n")) == [("a", 1)] * 4
    assert rows(keep_first(df, ["k", "n"])) == [("a", 1), ("b", 2)]


def test_except_all_is_a_multiset_difference(spark):
    left = [("a", None)] * 4 + [("b", 1)] * 2 + [(None, None)] * 3
    right = [("a", None)] * 1 + [("b", 1)] * 5 + [(None, None)] * 1 + [("c", 1)]
    schema = "x string, y int"
    l_df, r_df = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = except_all(l_df, r_df)
    assert rows(got) == rows(l_df.exceptAll(r_df))
    assert Counter(tuple(r) for r in got.collect()) == Counter(left) - Counter(right)


@pytest.mark.parametrize("block", [1, 7, 100, 10**6])
def test_repeat_rows_in_blocks(spark, block):
    times = {"a": 0, "b": 1, "c": 7, "d": 8, "e": 350, "f": -2}
    df = spark.createDataFrame(list(times.items()), "k string, _n bigint")
    got = repeat_rows(df, "_n", block)
    assert got.columns == ["k"]
    assert Counter(r["k"] for r in got.collect()) == Counter({k: n for k, n in times.items() if n > 0})


def test_many_copies_are_written_by_many_tasks(spark):
    df = spark.createDataFrame([("a", 80_000)], "k string, _n bigint")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        sizes = repeat_rows(df, "_n", 1000).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 40_000


def test_rows_come_out_as_read(spark):
    df = spark.createDataFrame([("k", 0.0), ("k", -0.0), ("k", -0.0), ("k", 5.0), (None, -0.0)], "k string, v double")
    marked = mark_surplus(df, ["k"], null_keys=False)
    got = sorted((r["k"] or "", str(r["v"]), r["_surplus"]) for r in marked.collect() if r["_surplus"] is not None)
    assert got == [("k", "-0.0", False), ("k", "-0.0", True), ("k", "0.0", True), ("k", "5.0", True)]
    assert [(r["k"], str(r["v"])) for r in marked.where("_surplus is null").collect()] == [(None, "-0.0")]


def test_no_window_and_no_job_for_a_hot_key(spark, capsys):
    df, _ = _skewed(spark, 3)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    marked = mark_surplus(df, ["k"])
    assert len(tracker.getJobIdsForGroup(None)) == before
    marked.explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan
    # the rows meet their key's first row in a join dealt by more than the key, which Spark can split
    assert "hashpartitioning(_key_hash" in plan


def test_empty_and_single_rows(spark):
    empty = spark.createDataFrame([], "k string, v int")
    assert mark_surplus(empty, ["k"]).count() == 0
    one = spark.createDataFrame([("a", None)], "k string, v int")
    assert [tuple(r) for r in mark_surplus(one, ["k"]).collect()] == [("a", None, False)]


@pytest.mark.parametrize("seed", [7, 8])
def test_surplus_and_first_rows(spark, seed):
    df, data = _skewed(spark, seed)
    present = [r for r in data if r[1] is not None]
    kept = _survivors(present, "k")
    assert Counter(tuple(r) for r in surplus_rows(df, ["k"]).collect()) == Counter(present) - kept
    first = first_rows(df.withColumn("flag", F.col("v") == "x"), ["k"], ["flag"])
    assert first.columns == [*df.columns, "flag"]
    assert Counter(tuple(r)[:3] for r in first.collect()) == kept
    assert all(r["flag"] == (None if r["v"] is None else r["v"] == "x") for r in first.collect())
    assert surplus_rows(df.where("false"), ["k"]).count() == first_rows(df.where("false"), ["k"], []).count() == 0


def test_surplus_rows_come_out_as_read(spark):
    df = spark.createDataFrame([("k", 0.0), ("k", -0.0), ("k", -0.0), ("k", 5.0), (None, -0.0)], "k string, v double")
    assert sorted(str(r["v"]) for r in surplus_rows(df, ["k"]).collect()) == ["-0.0", "0.0", "5.0"]
    assert [(r["k"], str(r["v"])) for r in first_rows(df, ["k"], []).collect()] == [("k", "-0.0")]


def test_only_rows_of_several_meet_their_first(spark, capsys):
    df, _ = _skewed(spark, 3)
    surplus_rows(df, ["k"]).explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan and "hashpartitioning(_key_hash" in plan
