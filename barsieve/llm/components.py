"""Connected components of a distributed list of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from barsieve.llm.common import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """For every end of an edge (`a`, `b`: longs), `node`, the smallest node it is connected to: `component`.

    Large-star and small-star steps in turn: every node hands its larger neighbours, then its smaller ones, to the
    smallest of them, until the edges are stars. A node's smallest neighbour is found by partial sums and meets its
    edges in a join, so no node's edges are gathered. Each round is written, so a lost executor costs one round.
    """
    current = staged(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        ways = _both_ways(current)
        low = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = ways.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("low"))
        small = down.join(least, "a").select("a", "b", "low")
        hung = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(
            small.select("a", F.col("low").alias("b"))
        )
        seen = Observation()
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest")
        hung = hung.where("a <> b").distinct().observe(seen, F.count(F.lit(1)).alias("edges"), digest)
        current = staged(hung, "edges")
        state = seen.get
        if state == before:
            break
        before = state
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
