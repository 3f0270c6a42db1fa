"""From documents to training sequences, in five stages; each is written as Parquet and read again by the next.

Rejected by the quality classifier, documents go; boilerplate lines go; of near copies one document stays; sources are
mixed to their weights; what is left is packed into sequences of tokens. A null or empty text passes the line and
near-copy stages as it is, has no words to mix, and packs as its end id where a stage lets it through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsieve.llm import line_dedup, mixing, ngram_join, packing, quality_gam
from barsieve.llm.common import documents, importable, small_batches, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _ready(spark: SparkSession) -> None:
    """Workers that find the package, and that are handed little at a time: the stages share their executors' memory."""
    importable(spark)
    small_batches(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled documents outside the held-out fold, accepts."""
    _ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_gam.classify(docs.select(COLUMNS), documents(spark, sf_dir), labels)
    return scored.where("predicted = 1").select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without their source's boilerplate lines."""
    _ready(spark)
    cut = line_dedup.drop_boilerplate(docs.select(COLUMNS))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id."""
    _ready(spark)
    return ngram_join.keep_one(docs.select(COLUMNS)).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that is taken twice is there twice."""
    _ready(spark)
    return mixing.mixed_documents(docs.select(COLUMNS)).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    _ready(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("ngram_join", near_copies),
    ("mixing", mixture),
    ("packing", packed),
]

#: A learned classifier and a fitted budget are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of `sf_dir`."""
    rows = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if k < len(STAGES) - 1:
            rows = staged(rows, name)
    return rows
