"""Near misses: many pairs just below the similarity give rows in proportion to documents, not to pairs."""

import random

import pytest

from barsieve.llm import ngram_join
from tests.llm.test_operators import _brute_components


def _near_misses(n, links):
    """Texts of a common stretch and some words of their own; each of the first `links` has a copy with one more word."""
    rng = random.Random(n)
    common = [f"w{i}" for i in range(150)]
    texts = {}
    for k in range(n):
        own = [f"own{k}x{rng.randrange(10**9)}" for _ in range(25)]
        texts[k] = " ".join(common + own)
        if k < links:
            texts[n + k] = texts[k] + " more"
    return texts


@pytest.mark.parametrize("block", [1024, 16])
def test_rows_are_linear_in_near_misses(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    sizes = {}

    def counted(df, label, staged=ngram_join.staged):
        table = staged(df, label)
        sizes[label] = max(sizes.get(label, 0), table.count())
        return table

    monkeypatch.setattr(ngram_join, "staged", counted)
    most = {}
    for n in (60, 240):
        sizes.clear()
        texts = _near_misses(n, 10)
        rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_copies(rows).collect()}
        assert got == _brute_components(texts)
        assert sum(c != k for k, (_, c) in got.items()) == 10
        # the tiles themselves are in proportion; with small blocks a class is in as many rows as there are blocks
        assert sizes["across"] <= n and sizes["partners"] <= sizes["tiles"] * (1 if block > n else n / block + 4)
        most[n] = {k: v for k, v in sizes.items() if k in ("tiles", "across", "bounded", "links", "star")}
    assert all(most[240][k] <= 4 * 2 * max(v, 60) for k, v in most[60].items())


def test_classes_of_one_band_meet_once(spark, monkeypatch):
    """Sets of one size share a hash in their own band's tile and in the next band's: only the first counts."""
    tables = {}

    def kept(df, label, staged=ngram_join.staged):
        tables[label] = staged(df, label)
        return tables[label]

    monkeypatch.setattr(ngram_join, "staged", kept)
    texts = _near_misses(60, 10)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_copies(rows).collect()}
    assert got == _brute_components(texts)
    assert 0 < tables["tiles"].count() <= ngram_join.TILES * len(texts)


@pytest.mark.parametrize("block", [1024, 4])
def test_links_across_bands(spark, monkeypatch, block):
    """Beginnings of one text in steps of less than a band: each links with those of its own band and the next."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(3)
    texts = {}
    for family in range(3):
        words = [f"f{family}w{i}" for i in range(400)]
        for k, length in enumerate((90, 105, 118, 124, 139, 150, 163, 185, 210, 240, 290, 330, 400)):
            text = words[:length]
            for _ in range(rng.randrange(3)):
                text[rng.randrange(length)] = f"new{family}x{k}x{rng.randrange(10**6)}"
            texts[family * 100 + k] = " ".join(text)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_copies(rows).collect()}
    assert got == _brute_components(texts)
    assert len({c for _, c in got.values()}) < len(texts) / 2
