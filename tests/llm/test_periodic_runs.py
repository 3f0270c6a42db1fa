"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barsieve.llm import periodic_runs
from barsieve.llm.queries import all_queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute_runs(words, least=12):
    """Every distance in turn; the smallest one at which a stretch is maximal is its period."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def _brute_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = _brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


_PIECE = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=14), st.integers(1, 6))


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(_PIECE, max_size=8), max_size=4))
def test_runs_of_made_words(texts):
    rows = [[w for piece, times in text for w in piece * times] for text in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    values = np.array([w for r in rows for w in r], dtype=np.uint64)
    found = periodic_runs.find_runs(values, bounds)
    assert [found.get(k, []) for k in range(len(rows))] == [_brute_runs(r) for r in rows]


def test_long_texts_with_many_repeats():
    rng = random.Random(2)
    phrase = list(range(9))
    lefts = [w for k in range(4000) for w in [100 + rng.randrange(2000), *phrase]]
    same = [5] * 30_000
    bounds = np.cumsum([0, len(lefts), len(same)])
    found = periodic_runs.find_runs(np.array(lefts + same, dtype=np.uint64), bounds)
    near = [r for r in found.get(0, []) if r[2] % 10]
    assert not near and found[1] == [(0, 30_000, 1)]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in all_queries()["op11_periodic_runs"](spark, sf_dir).collect()}
    assert got == {_brute_row(r["doc_id"], r["text"]) for r in docs}
    assert sum(r[1] for r in got) > len(docs) // 20


def test_edges(spark):
    again = "x y " * 6 + "z " + "a b c " * 4
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, again), (4, again), (None, again), (5, "q " * 12), (6, "q " * 11),
        (7, "Ü 中  \x85 " * 8), (8, " ".join(f"w{i}" for i in range(30_000))),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clash = docs.withColumns({c: F.lit("x") for c in ("extra", "runs", "start", "period", "collapsed")})
    plain = periodic_runs.with_runs(docs)
    found = plain.collect()
    assert sorted(found, key=repr) == sorted(periodic_runs.with_runs(clash).select(*plain.columns).collect(), key=repr)
    assert periodic_runs.with_runs(clash).where("extra = 'x'").count() == len(rows)
    assert periodic_runs.with_runs(docs.where("false")).count() == 0
    for r in found:
        words = WORD.findall(dict(rows)[r["doc_id"]] or "")
        want = _brute_runs(words) if len(words) < 1000 else []
        assert [tuple(x) for x in r["runs"]] == want
        gone = {i for s, length, q in want for i in range(s + q, s + length)}
        assert r["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert {r["doc_id"]: r["n_runs"] for r in found} == {
        1: 0, 2: 0, 3: 0, 4: 2, None: 2, 5: 1, 6: 0, 7: 1, 8: 0,
    }
    tails = periodic_runs.with_periodic_tails(clash.unionByName(clash.withColumn("doc_id", F.lit(None).cast("long"))))
    assert tails.columns == clash.columns and tails.where("doc_id is null and text is null").count() == 1
