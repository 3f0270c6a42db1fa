"""Very many equal rows: the same results as ever, and no group of them in one task."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barsieve.llm import attention_lm, mixing, ngram_join, packing, quality_gam

N = 50_000
TEXT = "seven words are in this short text"


@pytest.fixture(scope="module")
def equal_rows(spark):
    rows = spark.range(N).select(F.lit(7).cast("long").alias("doc_id"), F.lit(TEXT).alias("text"), F.lit("a").alias("source"))
    return rows.repartition(8)


@pytest.fixture(scope="module")
def others(spark):
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(1 + k % 40)), "ab"[k % 2]) for k in range(10, 300)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_packing_spreads_them(spark, equal_rows, others):
    found = packing.pack(equal_rows.unionByName(others)).select("doc_id", "sequence_id", "offset", "length").collect()
    repeated = [r for r in found if r["doc_id"] == 7]
    assert len(repeated) == N and len({(r["sequence_id"], r["offset"]) for r in found}) == len(found)
    groups = Counter(r["sequence_id"] >> 32 for r in found)
    assert len(groups) > 4 and max(groups.values()) < 2 * packing.GROUP
    filled = Counter()
    for r in found:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 1024 and sum(filled.values()) / (1024 * len(filled)) > 0.95


def test_mixing_counts_them(spark, equal_rows, others):
    docs = equal_rows.unionByName(others)
    found = mixing.mix(docs)
    rows = found.groupBy("doc_id", "source", "target", "copies").agg(F.count("*").alias("n"), F.sum("taken").alias("t")).collect()
    assert sum(r["n"] for r in rows if r["doc_id"] == 7) == N
    targets = {r["source"]: r["target"] for r in rows}
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["t"]
    assert all(abs(taken[s] - targets[s]) <= 7 for s in targets)
    copies = {r["copies"] for r in rows if r["doc_id"] == 7}
    assert max(copies) - min(copies) <= 1 and max(copies) <= 2
    again = {(r["doc_id"], r["copies"]): r["n"] for r in mixing.mix(docs).groupBy("doc_id", "copies").agg(F.count("*").alias("n")).collect()}
    assert again == {(r["doc_id"], r["copies"]): r["n"] for r in rows}
    documents = mixing.mixed_documents(docs.withColumn("extra", F.lit("x"))).groupBy("doc_id", "text", "extra").count().collect()
    want = Counter()
    for r in rows:
        want[r["doc_id"]] += r["n"] * r["copies"]
    assert {r["doc_id"]: r["count"] for r in documents} == {k: n for k, n in want.items() if n}


def test_mixing_ranks_them_once(spark, equal_rows, capsys):
    mixing.mix(equal_rows).explain()
    plan = capsys.readouterr().out
    window = plan[plan.index("Window") :]
    assert "HashAggregate" in window or "Aggregate" in window  # rows that are equal meet it as one


def test_language_model_spreads_them(spark, equal_rows, others, monkeypatch):
    monkeypatch.setattr(attention_lm, "CHUNK_BYTES", 1 << 18)
    sizes = {}

    def kept(df, label, staged=attention_lm.staged):
        table = staged(df, label)
        if label == "dealt":
            sizes.update({r["chunk"]: r["count"] for r in table.groupBy("chunk").count().collect()})
        return table

    monkeypatch.setattr(attention_lm, "staged", kept)
    found = attention_lm.score(equal_rows.unionByName(others))
    rows = found.where("doc_id = 7").groupBy("n_tokens", "n_known", "base_score", F.round("score", 6)).count().collect()
    assert [r["count"] for r in rows] == [N] and rows[0]["n_tokens"] == 8
    assert len(sizes) >= 6 and max(sizes.values()) < 2 * N / len(sizes)


def test_language_model_scores_equal_texts_equally():
    model, draw = attention_lm.AttentionModel(), np.random.default_rng(0)
    model.load(draw.normal(size=len(model.flat())) * 0.5)
    text = draw.integers(0, attention_lm.END, 7)
    texts = [text if k % 20 else draw.integers(0, attention_lm.END, k % 60) for k in range(3000)]
    scores = attention_lm.group_scores(model.tables(), np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
    assert len({scores[k] for k in range(3000) if k % 20}) == 1  # wherever they stand


def test_training_rows_are_bounded(spark, equal_rows, others):
    docs = equal_rows.unionByName(others)
    labels = spark.createDataFrame([(7, 1)] * 500 + [(7, 0)] + [(k, k % 2) for k in range(10, 300)], "doc_id long, quality int")
    found = quality_gam.training_rows(docs, labels, F.lit(True), 10_000).collect()
    assert len(found) == 292 and Counter(r["doc_id"] for r in found)[7] == 2
    few = quality_gam.training_rows(docs, labels, F.lit(True), 50).count()
    assert 0 < few < 120


def test_a_reused_id_takes_no_other_text_along(spark):
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, base), (4, base + " more"), (4, other), (4, other), (5, other + " x"), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in ngram_join.keep_one(docs).collect()]
    assert (1, base) in kept and (6, "") in kept and (4, base + " more") not in kept
    assert kept.count((4, other)) <= 1 and any(t in (other, other + " x") for _, t in kept)
