"""Mixing sources to target weights by fitting each source's word budget as a subset sum.

Sources in order of code points, null last, get the weights in turn. Together their targets are `share` of all words;
a target stops at `most` times its source's words, and what is above is shared again by weight until none is above.

A source's documents are counted by exact length in words. With a target above its size, every document is taken once
and the rest of the target is the budget; else the target is. Of each length, the documents that the budget's share
of the source allows are taken, rounded down. What remains is fitted with single documents: the longest that fit,
until the rest is short, then by dynamic programming over all sums with the counts left, which finds the largest sum
not above it. Where that still falls short, the shortest documents are given back until the longest would fit, and all
sums are tried again with up to `most` copies of each document. Which documents of a length are taken is decided by a seeded hash of doc_id, so reruns agree.

A null text has no words; documents without words are taken along at the budget's share and count nothing. Equal
doc_ids are rows of their own. An empty table gives an empty table. Input columns named like new ones are replaced.

One row for each source is sorted in one task, and a source's lengths (as many as the longest text has words, not as
there are documents) are fitted in one. Documents are chosen by counts of hash buckets; only the documents of the
bucket where a length's choice ends are ranked.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsieve.llm.common import staged, word_count
from barsieve.operators.duplicates import repeat_rows

WEIGHTS = (5, 2, 1)
SHARE, MOST, SEED = 1.5, 2, 20
#: Hash buckets of the documents of one length. Rest of a budget, in longest lengths, from which on sums are tabled.
BUCKETS, TABLED = 1024, 2


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row for each source: `source`, `sid` (its place), `source_size`, `target`."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * most
    everything, by_level = Window.partitionBy(), Window.orderBy("level", "sid")
    up_to = by_level.rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        totals.withColumn("sid", place)
        .withColumn("weight", weight)
        .withColumn("level", cap / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("lighter", F.sum("weight").over(everything) - F.sum("weight").over(up_to))
        .withColumn("full", F.sum(cap).over(up_to) + F.col("level") * F.col("lighter") <= F.col("total"))
    )
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(everything)
    left = F.col("total") - F.sum(F.when(F.col("full"), cap).otherwise(0)).over(everything)
    target = F.when(F.col("full"), cap.cast("double")).otherwise(left * F.col("weight") / open_weight)
    return ranked.select("source", "sid", "source_size", F.least(target, cap.cast("double")).alias("target"))


def _nearest_sum(lengths: np.ndarray, left: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length make the largest sum up to the budget; bounded by `left`. Lengths are above 0."""
    reach = np.zeros(budget + 1, dtype=bool)
    reach[0] = True
    through = np.full(budget + 1, -1, dtype=np.int64)
    chunks: list[tuple[int, int]] = []
    for k in np.argsort(-lengths, kind="stable"):
        copies, block = int(min(left[k], budget // lengths[k])), 1
        while copies > 0 and not reach[budget]:
            block = min(block, copies)
            step = int(lengths[k]) * block
            fresh = np.flatnonzero(reach[: budget + 1 - step] & ~reach[step:]) + step
            reach[fresh], through[fresh] = True, len(chunks)
            chunks.append((int(k), block))
            copies, block = copies - block, block * 2
        if reach[budget]:
            break
    taken = np.zeros(len(lengths), dtype=np.int64)
    at = int(np.flatnonzero(reach)[-1])
    while at:
        k, block = chunks[through[at]]
        taken[k] += block
        at -= int(lengths[k]) * block
    return taken


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, so that their words come as near below the budget as they can."""
    total = int(np.dot(lengths, counts))
    share = min(1.0, budget / total) if total else 0.0
    taken = np.minimum(np.floor(counts * share).astype(np.int64), counts)
    rest = budget - int(np.dot(lengths, taken))
    words = np.flatnonzero(lengths > 0)
    if not len(words):
        return taken
    for k in words[np.argsort(-lengths[words], kind="stable")]:
        spare = rest - TABLED * int(lengths.max())
        if spare <= 0:
            break
        more = int(min(counts[k] - taken[k], spare // lengths[k]))
        taken[k] += more
        rest -= more * int(lengths[k])
    fits = words[(lengths[words] <= rest) & (counts[words] > taken[words])]
    if rest > 0 and len(fits):
        rest = min(rest, int(np.dot(lengths[fits], counts[fits] - taken[fits])))
        taken[fits] += _nearest_sum(lengths[fits], (counts - taken)[fits], rest)
    return taken


def refit(lengths: np.ndarray, most: np.ndarray, taken: np.ndarray, budget: int) -> np.ndarray:
    """Come nearer to a budget that a choice falls short of, with up to `most` of each length.

    The shortest documents are given back until the longest would fit, and the rest is fitted anew by all sums.
    """
    rest = budget - int(np.dot(lengths, taken))
    words = np.flatnonzero(lengths > 0)
    if rest <= 0 or not len(words):
        return taken
    taken, longest = taken.copy(), int(lengths.max())
    for k in words[np.argsort(lengths[words], kind="stable")]:
        back = min(int(taken[k]), max(0, -(-(longest - rest) // int(lengths[k]))))
        taken[k] -= back
        rest += back * int(lengths[k])
    fits = words[(lengths[words] <= rest) & (most[words] > taken[words])]
    if len(fits):
        rest = min(rest, int(np.dot(lengths[fits], (most - taken)[fits])))
        taken[fits] += _nearest_sum(lengths[fits], (most - taken)[fits], rest)
    return taken


def _plan(rows: pd.DataFrame, most: int) -> pd.DataFrame:
    """For each length of a source, how often all of its documents are taken, and how many once more."""
    rows = rows.sort_values("size")
    lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    target, total = int(rows["target"].iloc[0]), int(np.dot(lengths, counts))
    times = min(most, target // total) if total else 0
    budget = target - times * total
    copies = times * counts + fit_budget(lengths, counts if times < most else 0 * counts, budget)
    copies = refit(lengths, most * counts, copies, target)
    rows = rows.assign(times=copies // counts, chosen=copies % counts)
    return rows[["sid", "size", "n", "times", "chosen"]]


def _row_key() -> Column:
    """128 bits that stand for a row's doc_id, source and text."""
    parts = ["doc_id", F.col("source").isNull(), F.coalesce("source", F.lit("")), F.col("text").isNull(), "text"]
    return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(3), *parts).alias("h2"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED
) -> DataFrame:
    """Each document's `doc_id` and `key`, with `size`, `source`, `source_size`, `target` and `taken`.

    `copies` says how often the mix holds the document.
    """
    sized = staged(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            _row_key().alias("key"),
            F.xxhash64(F.lit(seed), "doc_id").alias("order"),
        ),
        "sizes",
    )
    goals = staged(targets(sized, weights, share, most), "targets")
    same = sized["source"].eqNullSafe(goals["source"])
    rows = sized.join(goals, same).drop(goals["source"])
    lengths = rows.groupBy("sid", "size", "target").agg(F.count(F.lit(1)).alias("n"))
    plan = staged(
        lengths.groupBy("sid").applyInPandas(lambda g: _plan(g, most), "sid int, size long, n long, times long, chosen long"), "fit"
    )
    bucket = F.pmod("order", F.lit(BUCKETS))
    parts = plan.where("chosen > 0 and chosen < n").select("sid", "size", "chosen")
    in_bucket = (
        rows.join(parts, ["sid", "size"], "left_semi")
        .groupBy("sid", "size", bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("m"))
    )
    before = F.sum("m").over(Window.partitionBy("sid", "size").orderBy("bucket")) - F.col("m")
    edge = (
        in_bucket.join(parts, ["sid", "size"])
        .withColumn("before", before)
        .where("before < chosen and before + m >= chosen")
        .select("sid", "size", F.col("bucket").alias("edge"), (F.col("chosen") - F.col("before")).alias("need"))
    )
    full = staged(plan.join(edge, ["sid", "size"], "left"), "plan")
    found = staged(rows.join(full, ["sid", "size"]).withColumn("bucket", bucket), "chosen")
    on_edge = F.col("bucket") == F.col("edge")
    clear = F.col("edge").isNull() | ~on_edge
    taken_one = F.when(F.col("edge").isNull(), F.col("chosen") > 0).otherwise(F.col("bucket") < F.col("edge"))
    # rows that are equal throughout are ranked as one, with their number, and written again afterwards
    alike = found.where(on_edge).groupBy(*found.columns).agg(F.count(F.lit(1)).alias("alike"))
    by_rank = Window.partitionBy("sid", "size").orderBy("order", "doc_id", "key")
    alike = alike.withColumn("before", F.sum("alike").over(by_rank) - F.col("alike"))
    first = F.greatest(F.lit(0), F.least("alike", F.col("need") - F.col("before"))).cast("long")
    turns = [F.struct(first.alias("alike"), F.lit(1).cast("long").alias("more"))]
    turns += [F.struct((F.col("alike") - first).alias("alike"), F.lit(0).cast("long").alias("more"))]
    ranked = alike.withColumn("turn", F.explode(F.array(*turns))).select(*found.columns, "turn.alike", "turn.more")
    ranked = repeat_rows(ranked, "alike")
    all_rows = found.where(clear).withColumn("more", taken_one.cast("long")).unionByName(ranked)
    copies = F.col("times") + F.col("more")
    return all_rows.select(
        "doc_id", "key", "source", "size", "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of `docs`.

    Rows that share doc_id, source and text are taken equally often, and one of them as often again as is left.
    """
    keys, names = ["_k1", "_k2"], docs.columns
    found = mix(docs, **options).select(F.col("key.h1").alias("_k1"), F.col("key.h2").alias("_k2"), "copies")
    taken = found.groupBy(*keys).agg(F.min("copies").alias("_each"), F.sum("copies").alias("_all"), F.count("*").alias("_n"))
    taken = staged(taken.where("_all > 0"), "copies")
    own = _row_key()
    keyed = docs.withColumns({"_k1": own["h1"], "_k2": own["h2"]})
    each = keyed.join(taken.where("_each > 0").select(*keys, "_each"), keys)
    each = each.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_each").cast("int")))).select(*names)
    left = taken.withColumn("_left", F.col("_all") - F.col("_each") * F.col("_n")).where("_left > 0").select(*keys, "_left")
    left = staged(left, "left")  # mostly few rows or none, which Spark knows of a written table
    one = keyed.join(left.select(*keys), keys).groupBy(*keys).agg(F.any_value(F.struct(*names)).alias("_row"))
    return each.unionByName(repeat_rows(left, "_left").join(one, keys).select("_row.*"))
