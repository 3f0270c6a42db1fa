"""Line dedup by site-relative frequency: a line on too large a share of a site's pages is boilerplate.

For each host, the pages that hold a line are counted (a page once, however often it repeats the line) and divided
by the host's pages. Lines on `min_pages` pages or more whose share exceeds `ratio` are dropped wherever they stand
on that host's pages; all others stay, in order. Lines are cut at line feeds and compared by 128 bits of hash. Lines
of white space only are never boilerplate. A null host is a host of its own. A null text stays null and counts as a
page without lines; an empty text stays empty, and a page whose lines all go gets an empty text. Repeated rows are
pages of their own. Other columns are carried along; an input column named like a new one is replaced. An empty
table gives an empty table.

Pages of a hot host or line are counted by partial sums. Boilerplate is at most (lines a page / ratio) lines a host,
so it is kept as one array for each host. That table is written first: Spark then sees its size, and either
broadcasts it or joins by host in partitions that it may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsieve.llm.common import staged

RATIO = 0.1
MIN_PAGES = 5


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), line).alias("h2"))


def boilerplate(pages: DataFrame, host: str, text: str, ratio: float, min_pages: int) -> DataFrame:
    """For each host that has any, the keys of its boilerplate lines: `site`, `bad`."""
    site = F.col(host).alias("site")
    lines = pages.select(site, F.explode(F.array_distinct(F.split(F.col(text), "\n"))).alias("line"))
    counts = (
        lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
        .select("site", _key(F.col("line")).alias("key"))
        .groupBy("site", "key.h1", "key.h2")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
    )
    totals = pages.select(site).groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    totals = totals.withColumnRenamed("site", "total_site")
    bad = counts.join(totals, F.col("site").eqNullSafe(F.col("total_site"))).where(F.col("n") > ratio * F.col("pages"))
    return bad.groupBy("site").agg(F.sort_array(F.collect_list(F.struct("h1", "h2"))).alias("bad"))


def drop_boilerplate(
    pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The pages without boilerplate lines, and `n_lines` and `n_dropped` for each."""
    found = staged(boilerplate(pages, host, text, ratio, min_pages), "boilerplate")
    site, bad = found.select(F.col("site").alias("_site"), F.col("bad").alias("_bad")), F.col("_bad")
    rows = pages.drop("n_lines", "n_dropped").join(site, F.col(host).eqNullSafe(F.col("_site")), "left")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x: ~F.array_contains(bad, _key(x)))
    whole = F.col(text).isNull() | bad.isNull()
    size = lambda column: F.coalesce(F.size(column), F.lit(0)).cast("long")
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(size(lines)).cast("long")
    n_kept = F.when(F.col(text).isNull(), 0).when(bad.isNull(), n_lines).otherwise(size(kept)).cast("long")
    return rows.withColumns(
        {
            "n_lines": n_lines,
            "n_dropped": n_lines - n_kept,
            text: F.when(whole, F.col(text)).otherwise(F.array_join(kept, "\n")),
        }
    ).drop("_site", "_bad")
