"""Surplus rows per key, one row per key, and multiset difference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Copies of one row are written in blocks of this many rows.
COPY_BLOCK = 1_000_000

_HASH, _FIRST, _SAME, _N = "_key_hash", "_first", "_same", "_n"


def keep_first(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest by the other columns, nulls first.

    An aggregate, so every task sends at most one row per key through the shuffle. The smallest row is a struct, which
    Spark aggregates by sorting each task's rows by key first.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col("_kept")[c].alias(c) for c in df.columns])


def repeat_rows(df: DataFrame, times: str, block: int = COPY_BLOCK, number: str | None = None) -> DataFrame:
    """Each row as often as its `times` column says; that column is dropped, `number` numbers the copies from 1.

    Rows with more copies than one block are first spread by block, so that no task writes them all.
    """
    columns = [c for c in df.columns if c != times]
    few = df.where(F.col(times).between(1, block)).withColumn("_from", F.lit(1).cast("long"))
    many = (
        df.where(F.col(times) > block)
        .withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col(times), F.lit(block))))
        .repartition(*columns, "_from")
    )
    last = F.least(F.col(times), F.col("_from") + (block - 1))
    copies = few.unionByName(many).withColumn("_copy", F.explode(F.sequence("_from", last)))
    return copies.select(*columns, *([] if number is None else [F.col("_copy").alias(number)]))


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Multiset difference: each distinct row as often as it occurs in `left` more than in `right`.

    Copies are counted before the shuffle, so a row with very many copies costs one row per task. Rows are told apart
    as by grouping: a negative zero is a zero, and comes out as one.
    """
    columns = left.columns
    signed = left.withColumn(_N, F.lit(1).cast("long")).unionByName(
        right.select(*columns).withColumn(_N, F.lit(-1).cast("long"))
    )
    counted = signed.groupBy(*columns).agg(F.sum(_N).alias(_N)).where(F.col(_N) > 0)
    return repeat_rows(counted, _N)


def mark_surplus(df: DataFrame, keys: list[str], flag: str = "_surplus", null_keys: bool = True) -> DataFrame:
    """Flag all but one row per key; the row that stays is the smallest by the other columns, nulls first.

    Rows come out as they were read. The smallest row of a key is found by an aggregate and joined to the key's rows,
    in partitions that Spark may split; rows that equal it throughout are counted and written again in blocks. So no
    task has to take all rows of a key. The input is evaluated twice. Without `null_keys`, rows with a null in
    a key are no duplicates of each other and get a null flag.
    """
    firsts = _firsts(df if null_keys else df.where(_present(keys)), keys)
    joined = _beside_first(df, firsts, keys, null_keys, "inner" if null_keys else "left")
    differing = joined.where(~F.col(_SAME)).select(
        *df.columns, F.when(F.col(_FIRST).isNotNull(), F.lit(True)).alias(flag)
    )
    copies = repeat_rows(_counted_firsts(joined, keys), _N, number="_copy")
    return differing.unionByName(copies.withColumn(flag, F.col("_copy") > 1).drop("_copy"))


def surplus_rows(df: DataFrame, keys: list[str], seen: DataFrame | None = None) -> DataFrame:
    """The rows that `mark_surplus` flags, of keys without a null: all rows of a key but the smallest.

    Only keys with several rows have a first row to meet, and only their rows come out of the join. Of the keys in `seen`,
    whose first rows are elsewhere, all rows are surplus.
    """
    if seen is not None:
        fresh = surplus_rows(df.join(seen, keys, "left_anti").select(df.columns), keys)
        return df.join(seen, keys, "left_semi").select(df.columns).unionByName(fresh)
    firsts = _firsts(df.where(_present(keys)), keys).where(F.col(_N) > 1).drop(_N)
    joined = _beside_first(df.where(_present(keys)), firsts, keys, True, "inner")
    copies = _counted_firsts(joined, keys).withColumn(_N, F.col(_N) - 1)
    return joined.where(~F.col(_SAME)).select(*df.columns).unionByName(repeat_rows(copies, _N))


def first_rows(df: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """The row of each key without a null that `mark_surplus` does not flag, as read.

    The columns `carried` come along and take no part in the order. One aggregate, in which every task sends at most one
    row per key.
    """
    own = df.drop(*carried)
    row = F.struct(*_order(own, keys), F.struct(*own.columns).alias("_row"), *carried)
    kept = df.where(_present(keys)).groupBy(*keys).agg(F.min(row).alias(_FIRST))
    return kept.select(f"{_FIRST}._row.*", *[F.col(_FIRST)[c].alias(c) for c in carried])


def _present(keys: list[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def _firsts(df: DataFrame, keys: list[str]) -> DataFrame:
    """The smallest row of each key, and the number of its rows."""
    row = F.struct(*_order(df, keys), F.struct(*df.columns).alias("_row"))
    return df.groupBy(*keys).agg(F.min(row).alias(_FIRST), F.count(F.lit(1)).alias(_N))


def _beside_first(df: DataFrame, firsts: DataFrame, keys: list[str], null_keys: bool, how: str) -> DataFrame:
    """Rows with the first row of their key, and whether they equal it throughout."""
    # The hash makes the join deal rows by more than the keys, so Spark does not take over the partitions of the
    # aggregate and can split a large one. Rows without a partner are spread by all their columns.
    key_hash = F.xxhash64(*keys)
    spread = key_hash if null_keys else F.when(_present(keys), key_hash).otherwise(F.xxhash64(*df.columns))
    rows = df.withColumn(_HASH, spread)
    firsts = firsts.select(key_hash.alias("_h"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], _FIRST)
    same_key = F.col(_HASH) == F.col("_h")
    for i, k in enumerate(keys):
        other = F.col(f"_k{i}")
        same_key = same_key & (F.col(k).eqNullSafe(other) if null_keys else F.col(k) == other)
    order = [F.col(_FIRST)[f"_o{i}"].eqNullSafe(c) for i, c in enumerate(_order(df, keys, named=False))]
    same = F.col(_FIRST).isNotNull()
    for c in order:
        same = same & c
    return rows.join(firsts, same_key, how).withColumn(_SAME, same)


def _counted_firsts(joined: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key and how many rows equal it."""
    counted = joined.where(_SAME).groupBy(*keys).agg(F.count("*").alias(_N), F.any_value(_FIRST).alias(_FIRST))
    return counted.select(f"{_FIRST}._row.*", _N)


def _order(df: DataFrame, keys: list[str], named: bool = True) -> list[Column]:
    """What rows of a key are ordered by: the other columns, then the text of fractions, where -0.0 is not 0.0."""
    parts = [F.col(c) for c in df.columns if c not in keys]
    parts += [F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return [c.alias(f"_o{i}") for i, c in enumerate(parts)] if named else parts
