"""Phrases against brute force, and the filter they are counted in against dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barsieve.llm import collocations, quotient_filter
from barsieve.llm.quotient_filter import U64


@settings(max_examples=200, deadline=None)
@given(data=st.data(), bits=st.integers(1, 63))
def test_filters_lose_nothing(data, bits):
    keys = st.integers(0, (1 << bits) - 1)
    shards = data.draw(st.lists(st.dictionaries(keys, st.integers(1, 1 << 40), max_size=40), min_size=1, max_size=4))
    filters = []
    for shard in shards:
        found = np.array(sorted(shard), dtype=np.uint64)
        spread = quotient_filter.permuted(found, bits)
        assert (spread < U64(1 << bits)).all()
        assert (quotient_filter.unpermuted(spread, bits) == found).all()
        order = np.argsort(spread)
        counts = np.array([shard[k] for k in found.tolist()], dtype=np.int64)[order]
        filters.append(quotient_filter.unpack(quotient_filter.pack(spread[order], counts, bits)))
        assert (filters[-1][0] == spread[order]).all() and (filters[-1][1] == counts).all()
    values, counts, places = quotient_filter.merged(filters)
    want = sum((Counter(s) for s in shards), Counter())
    got = dict(zip(quotient_filter.unpermuted(values, bits).tolist(), counts.tolist(), strict=True))
    assert got == dict(want)
    for (own, _), place in zip(filters, places, strict=True):
        assert (values[place] == own).all()


def test_permutation_of_a_small_width():
    for bits in (1, 2, 5, 12):
        every = np.arange(1 << bits, dtype=np.uint64)
        assert sorted(quotient_filter.permuted(every, bits).tolist()) == every.tolist()


@settings(max_examples=60, deadline=None)
@given(values=st.lists(st.integers(0, 1 << 50), max_size=30))
def test_numbers_in_planes(values):
    packed = collocations.packed_numbers(np.array(values, dtype=np.int64))
    assert collocations.unpacked_numbers(packed).tolist() == values


def _brute(rows, least, longest, top, contained):
    totals, counts = Counter(), Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    frequent = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    covered = set()
    for (lang, words), above in frequent.items():
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                part = (lang, words[i : i + n])
                if 100 * above >= contained * counts[part]:
                    covered.add(part)
    found = {}
    for (lang, words), a in frequent.items():
        if (lang, words) in covered:
            continue
        cuts = []
        for k in range(1, len(words)):
            x, y = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (x * y), k, x, y))
        score, _, x, y = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), x, y))
    out = set()
    for lang, listed in found.items():
        for rank, (score, a, phrase, x, y) in enumerate(sorted(listed)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, x, y, totals[lang], -score))
    return out


def _corpus(seed, texts):
    rng = random.Random(seed)
    words = ["Aa", "b", "ç", "中", "dd", "e-e"]
    phrases = ["b aa dd", "x y", "x y z", "p q r s t", "p q r s t u", "e-e e-e"]
    rows = []
    for _ in range(texts):
        parts = [rng.choice([*words, *phrases]) + rng.choice([" ", " ", "\t", ". ", "\n", ",", " ?"]) for _ in range(40)]
        rows.append((rng.choice(["en", "fr", None]), "".join(parts)))
    return rows


@pytest.mark.parametrize("least, longest, top, contained", [(3, 5, 2000, 100), (2, 3, 7, 80), (20, 5, 10, 100)])
def test_phrases_of_made_texts(spark, monkeypatch, least, longest, top, contained):
    monkeypatch.setattr(collocations, "MERGED_KEYS", 64)  # many ranges
    rows = _corpus(least, 60)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    found = collocations.collocations(docs, least, longest, top, contained).collect()
    assert {tuple(r) for r in found} == _brute(rows, least, longest, top, contained)
    assert len(found) == len(set(found)) > 5


def test_scores_beyond_64_bits(spark):
    row = [(2**53, 2**55, 2**54, 2**56)]
    df = spark.createDataFrame(row, "a long, l long, r long, n long")
    df = df.select(*[collocations._exact(c).alias(f"_{c}") for c in df.columns])
    a, x, y, n = row[0]
    got = df.select(F.expr("(_a * _n * cast(1000 as decimal(4,0))) div (_l * _r)")).first()[0]
    assert got == 1000 * a * n // (x * y)


def test_edges(spark):
    rows = [(None, None), ("en", ""), ("en", " \t\n.,"), (None, "a b. " * 3), ("und", "A B"), ("en", "a b\n" * 4)]
    rows += [("en", " ".join(f"w{i}" for i in range(30_000)))] * 2
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns(
        {c: F.lit("x") for c in ("chunk", "word", "a", "n", "ids", "phrase")}
    )
    found = {tuple(r) for r in collocations.collocations(docs, 4).collect()}
    assert found == _brute(rows, 4, 5, 2000, 100) == {
        ("und", 1, "a b", 4, 4, 4, 8, 2000), ("en", 1, "a b", 4, 4, 4, 60_008, 15_002_000),
    }
    assert collocations.collocations(docs, 1000).count() == 0
    assert collocations.collocations(docs.where("false")).count() == 0
