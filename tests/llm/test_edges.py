"""Every operator and stage on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barsieve.llm import (
    attention_lm,
    embed_dedup,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_gam,
    quality_rules,
    suffix_dedup,
)

LONG = " ".join(f"word{i}" for i in range(30_000))
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, "one two three four five six seven", "en", "b", 33),
    (4, "one two three four five six seven", "en", "b", 33),
    (5, "One two three four five six seven", "en", None, 33),
    (6, LONG, "en", "b", len(LONG)),
    (None, "no id here but some words all the same", "en", "b", 38),
    (7, "ß é 中文 \U0001f600 \x00 \x85end", None, "b", 16),
    (8, "short", "en", "c", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = [(4, 1, 0), (6, 1, 0), (8, 0, 0), (8, 0, 0), (None, 1, 0), (2, None, 0), (99, 1, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def _clash(df, *names):
    """The rows with further columns, some named like those that an operator makes."""
    return df.withColumns({n: F.lit("x") for n in ("extra", *names)})


def _operators(labels):
    learn = quality_gam.fold(F.col("doc_id"), 5) != 0
    model = quality_rules.train
    return {
        "line": (lambda d: line_dedup.drop_boilerplate(d), ("n_lines", "n_dropped", "bad", "site")),
        "join": (ngram_join.near_copies, ("component_id", "tiles", "node")),
        "pack": (packing.pack, ("start", "group", "sequence_id")),
        "gam": (lambda d: quality_gam.classify(d, d, labels), ("score", "predicted", "label")),
        "suffix": (lambda d: suffix_dedup.without_repeats(d), ("t1", "runs", "kept", "start")),
        "mix": (mixing.mix, ("size", "key", "target", "copies")),
        "lm": (attention_lm.score, ("learn", "chunk", "score")),
        "pii": (pii.personal_data, ("spans", "n_email")),
        "rules": (lambda d: quality_rules.judge(d, model(d, labels, learn)), ("kept", "n_words", "probability")),
    }


@pytest.mark.parametrize("name", ["line", "join", "pack", "gam", "suffix", "mix", "lm", "pii", "rules"])
def test_edge_rows_and_empty_tables(docs, labels, name):
    run, clashes = _operators(labels)[name]
    plain = run(docs)
    found = plain.collect()
    assert len(found) >= len(ROWS)
    if name != "pack":
        assert len(found) == len(ROWS)
        ids = sorted((r["doc_id"] for r in found), key=repr)
        assert ids == sorted((r[0] for r in ROWS), key=repr)
    own = [c for c in plain.columns if c not in docs.columns]
    again = run(_clash(docs, *clashes)).select("doc_id", *own)
    key = lambda r: repr([r["doc_id"], *[r[c] for c in own if c != "sequence_id"]])
    assert sorted(map(key, again.collect())) == sorted(map(key, found))
    assert run(docs.where("false")).count() == 0


def test_vectors_on_the_edge(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [1.0, None]), (9, []), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (11, [1e200, 1e199]), (12, [-0.0, 1e-310]),
    ]
    df = _clash(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "node", "n_links", "vector")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.near_vectors(df).collect()}
    assert got == {
        1: (3, 1, True), 2: (3, 1, False), 3: (3, 1, False), 11: (3, 1, False), 12: (0, 12, True), None: (0, None, True),
        **{k: (0, k, True) for k in (4, 5, 6, 7, 8, 9, 10)},
    }
    assert embed_dedup.near_vectors(df.where("false")).count() == 0


def test_defined_results(docs, labels):
    joined = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_copies(docs).collect()}
    assert joined == {
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 3, 4), (5, 3, 4), (6, 29996, 6), (None, 5, None), (7, 2, 7), (8, 1, 8),
    }
    kept = sorted((r["doc_id"] for r in ngram_join.keep_one(docs).collect()), key=repr)
    assert kept == sorted([1, 2, 3, 4, 6, 7, 8, None], key=repr)
    pieces = packing.pieces(docs.where("doc_id in (1, 2)")).collect()
    end = zlib.crc32(b"\0\0\0\0")
    assert sorted(tuple(r) for r in pieces) == [(1, 0, 1, end, 1), (2, 0, 1, end, 1)]
    cut = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix_dedup.without_repeats(docs).collect()}
    assert cut[1] == cut[2] == (0, 0, 0) and cut[6] == (len(LONG), 0, 0)
    scored = {r["doc_id"]: r for r in attention_lm.score(docs).collect()}
    assert scored[1]["n_tokens"] == 1 and scored[6]["n_tokens"] == 30_001
    assert scored[None]["held_out"] is False
    judged = {r["doc_id"]: r for r in quality_rules.judge(docs, None).collect()}
    assert judged[1]["base_failed"] and not judged[1]["kept"] and judged[6]["kept"]


def test_without_labels(docs, labels):
    none = labels.where("false")
    assert {r["score"] for r in quality_gam.classify(docs, docs, none).collect()} == {0.5}
    one = labels.where("quality = 1")
    scores = {round(r["score"], 3) for r in quality_gam.classify(docs, docs, one).collect()}
    assert scores == {0.999}
    assert quality_rules.train(docs, none, F.lit(True)) is None


def test_stages_on_edge_rows(spark, docs, labels, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    extra = _clash(docs, "size", "score", "copies", "n_lines", "component_id", "_turn")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        for rows in (docs, extra, docs.where("false")):
            found = stage(spark, rows, str(tmp_path))
            count = found.count()
            assert count == 0 or rows.count()
            if k < len(corpus_pipeline.STAGES) - 1:
                assert found.columns == docs.columns, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
