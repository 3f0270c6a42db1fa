"""The operators against brute force, exact round trips and held-out accuracy."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barsieve.llm import (
    attention_lm,
    components,
    embed_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_gam,
    quality_rules,
    suffix_dedup,
    textblocks,
)
from barsieve.llm.queries import all_queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = st.text(alphabet="aAé \n\tb.中\x00", max_size=40)


def _lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


# Words and lines


@settings(max_examples=60, deadline=None)
@given(values=st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_text_blocks(values):
    block = textblocks.TextBlock(pa.array(["skipped", *values], pa.string())[1:], lower=True)
    raw = block.data.tobytes()
    for spans, want in (
        (block.words, [WORD.findall(_lower(v or "")) for v in values]),
        (block.lines, [_lower(v or "").split("\n") for v in values]),
    ):
        got = [[] for _ in values]
        for a, b, row in zip(spans.start, spans.end, spans.row, strict=True):
            got[row].append(raw[a:b].decode())
        assert got == want
        assert spans.counts.tolist() == [len(w) for w in want]
    words = [w for v in values for w in WORD.findall(_lower(v or ""))]
    assert len(set(block.word_hashes.tolist())) == len(set(words))
    runs, cuts = textblocks.windows(block.word_hashes, block.words.bounds, 3)
    assert np.diff(cuts).tolist() == [max(0, len(WORD.findall(v or "")) - 2) for v in values]


# Components


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    rng.shuffle(edges)
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert {r["node"]: r["component"] for r in got.collect()} == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# N-gram join


def _sets(texts):
    out = {}
    for key, text in texts.items():
        words = WORD.findall(_lower(text))
        runs = [tuple(words)] if 0 < len(words) < 5 else [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        out[key] = frozenset(runs)
    return out


def _brute_components(texts):
    sets, parent = _sets(texts), {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for key, runs in sets.items():
        for r in runs:
            holders[r].append(key)
    shared = Counter((a, b) for keys in holders.values() for a in keys for b in keys if a < b)
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in texts}


def test_ngram_join_matches_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts = {}
    for group in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 30, 120, 400]))]
        for copy in range(rng.choice([1, 2, 30])):
            words = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.005, 0.02, 0.04]) else w for w in base]
            texts[len(texts) * 3 + group % 3] = " ".join(words[: max(1, len(words) - copy % 4)]).title()
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_copies(rows).collect()}
    assert got == _brute_components(texts)


def test_ngram_bounds():
    rng = np.random.default_rng(3)
    for n, m, common in ((100, 130, 80), (5, 5, 5), (1000, 760, 700), (40, 1, 0)):
        values = rng.integers(0, 2**63, size=n + m, dtype=np.uint64)
        x, y = np.sort(values[:n]), np.sort(np.concatenate([values[:common], values[n : n + m - common]]))
        raw = [np.frombuffer(ngram_join.bitmap(v), dtype=np.uint64) for v in (x, y)]
        assert common <= ngram_join.overlap_bound(n, raw[0], m, raw[1]) <= min(n, m)
    sizes = np.arange(1, 3000)
    band = ngram_join._band(sizes)
    for n in sizes:
        assert band[min(len(sizes) - 1, 4 * n // 3 - 1)] - band[n - 1] in (0, 1)


def test_ngram_query(spark, sf_dir, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in all_queries()["op2_ngram_join"](spark, sf_dir).collect()}
    assert got == _brute_components(texts)


# Packing


def test_packing_round_trip(spark, sf_dir, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for k, t in texts.items()}
    rows = all_queries()["op3_packing"](spark, sf_dir).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], dtype="<u4")
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for key, found in pieces.items():
        found.sort()
        assert [s for s, _ in found] == np.cumsum([0, *(n for _, n in found[:-1])]).tolist()
        assert sum(n for _, n in found) == len(ids[key])
    assert set(pieces) == set(texts)
    for found in sequences.values():
        found.sort()
        assert [s for s, _ in found] == np.cumsum([0, *(n for _, n in found[:-1])]).tolist()
        assert sum(n for _, n in found) <= 1024
    used = sum(map(len, ids.values()))
    assert used / (1024 * len(sequences)) > 0.97
    again = all_queries()["op3_packing"](spark, sf_dir).collect()
    assert sorted(again) == sorted(rows)


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 32), min_size=1, max_size=60))
def test_first_fit(lengths):
    lengths = sorted(lengths, reverse=True)
    sequence, offset = packing.first_fit_decreasing(np.array(lengths), 32)
    room = []
    for n, s, at in zip(lengths, sequence, offset, strict=True):
        first = next((k for k, r in enumerate(room) if r >= n), len(room))
        if first == len(room):
            room.append(32)
        assert (s, at) == (first, 32 - room[first])
        room[first] -= n


# Classifier and rules


def test_classifier_on_held_out_rows(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = all_queries()["op4_quality_classifier"](spark, sf_dir).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.85


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 5))
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    assert (1, 3) == model.pairs[0][:2]
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_rules_match_brute_force(spark, sf_dir, texts):
    found = {r["doc_id"]: r for r in all_queries()["op10_quality_rules"](spark, sf_dir).collect()}
    assert set(found) == set(texts)
    for key, text in texts.items():
        words, r = WORD.findall(text), found[key]
        runs = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        seen = Counter(runs)
        covered = {k + d for k, run in enumerate(runs) if seen[run] > 1 for d in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        counted = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)))
        assert counted == tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines"))
        assert r["n_repeat_words"] == len(covered)
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        assert r["base_failed"] == failed and not (failed and r["kept"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [(r["kept"], labels[k]) for k, r in found.items() if k in labels and not r["base_failed"]]
    assert sum(kept == bool(label) for kept, label in judged) / len(judged) > 0.9


def test_calibration_gives_probabilities():
    rng = np.random.default_rng(2)
    total = rng.normal(size=20_000) * 3
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(0.5 * total + 1)))).astype(float)
    slope, offset = quality_rules.calibrate(total, y)
    assert abs(slope - 0.5) < 0.03 and abs(offset - 1) < 0.06
    assert np.isfinite(quality_rules.calibrate(np.array([-1.0, 1.0, 2.0]), np.array([0.0, 1.0, 1.0]))).all()


# Suffix dedup


def _brute_repeats(texts, length):
    raw = {k: t.encode() for k, t in texts.items()}
    starts = Counter(b[p : p + length] for b in raw.values() for p in range(len(b) - length + 1))
    out = {}
    for key, b in raw.items():
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - length + 1):
            if starts[b[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out[key] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("kinds", [4096, 1])
def test_suffix_dedup_matches_brute_force(spark, kinds):
    rng = random.Random(4)
    piece = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    common = [piece(n) for n in (39, 40, 41, 80, 300)]
    texts = {k: "".join(rng.choice([piece(rng.randrange(60)), rng.choice(common)]) for _ in range(6)) for k in range(60)}
    texts |= {100: texts[0], 101: "ab" * 70, 102: "x" * 39, 103: "x" * 41, 104: "x" * 40}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = suffix_dedup.without_repeats(rows, length=40, gram=12, kinds=kinds)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)]
    assert {r[0]: tuple(r)[1:] for r in found.select(*columns).collect()} == _brute_repeats(texts, 40)


def test_suffix_query(spark, sf_dir, texts):
    rows = all_queries()["op5_suffix_dedup"](spark, sf_dir).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == _brute_repeats(texts, 400)


@settings(max_examples=60, deadline=None)
@given(pieces=st.lists(st.text(alphabet="ab", min_size=0, max_size=40), min_size=1, max_size=6), length=st.integers(1, 9))
def test_repeated_starts(pieces, length):
    raw = [p.encode() for p in pieces]
    seen = Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    want = [[p for p in range(len(b) - length + 1) if seen[b[p : p + length]] > 1] for b in raw]
    assert [f.tolist() for f in suffix_dedup.repeated_starts(raw, length)] == want


# Mixing


def _brute_targets(totals):
    names = sorted((s for s in totals if s is not None)) + ([None] if None in totals else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(totals.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 2 * totals[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * totals[s]
            left -= target[s]
            open_.remove(s)
    return target


def test_mixing(spark, sf_dir, documents, texts):
    source = {r["doc_id"]: r["source"] for r in documents.select("doc_id", "source").collect()}
    size = {k: len(WORD.findall(t)) for k, t in texts.items()}
    totals = Counter()
    for k, s in source.items():
        totals[s] += size[k]
    target = _brute_targets(totals)
    rows = all_queries()["op6_mixing"](spark, sf_dir).collect()
    taken = Counter()
    for r in rows:
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], totals[source[r["doc_id"]]])
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]])
        assert r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
    smallest = defaultdict(list)
    for k, s in source.items():
        smallest[s].append(size[k])
    for s, goal in target.items():
        assert 0 <= goal - taken[s] <= max(min(smallest[s]), 0.03 * goal)
    assert sorted(all_queries()["op6_mixing"](spark, sf_dir).collect()) == sorted(rows)
    twice = mixing.mixed_documents(documents).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in twice if size[r["doc_id"]]} == {
        r["doc_id"]: r["taken"] // r["size"] for r in rows if r["taken"]
    }


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 5), min_size=1, max_size=8), st.integers(0, 200))
def test_nearest_sum(counts, budget):
    lengths, left = np.array(list(counts)), np.array(list(counts.values()))
    budget = min(budget, int(lengths @ left))
    sums = {0}
    for n, c in counts.items():
        sums = {s + n * k for s in sums for k in range(c + 1)}
    found = mixing._nearest_sum(lengths, left, budget)
    assert (found <= left).all() and int(found @ lengths) == max(s for s in sums if s <= budget)


# Language model


def test_language_model(spark, sf_dir, texts):
    tokens = {k: [*WORD.findall(_lower(t)), None] for k, t in texts.items()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    counts = Counter(w for k, words in tokens.items() if not held[k] for w in words)
    n, v = sum(counts.values()), len(counts)
    found = {r["doc_id"]: r for r in all_queries()["op7_attention_lm"](spark, sf_dir).collect()}
    assert set(found) == set(texts)
    for key, words in tokens.items():
        r = found[key]
        known = sum(counts[w] > 0 for w in words)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[key], len(words), known, n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
    unseen = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_language_model_reads_long_texts_to_their_end(spark):
    body = " ".join(f"w{i % 50}" for i in range(3000))
    ends = {k: "last" if k % 2 else "seldom" if k == 2 else "other" for k in range(60)}
    rows = [(k, f"{body} {end}") for k, end in ends.items()]
    fold = lambda k: zlib.crc32(str(k).encode()) % 7
    held = [k for k in range(1000, 1100) if fold(k) == 2][:3]
    rows += [(held[0], f"{body} last"), (held[1], f"{body} other"), (held[2], f"{body} neverseen")]
    got = {r["doc_id"]: r for r in attention_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {r["n_tokens"] for r in got.values()} == {3002}
    assert got[0]["train_tokens"] == 3002 * sum(fold(k) != 2 for k in got)
    assert [got[k]["n_known"] for k in held] == [3002, 3002, 3001]
    assert len({round(got[k]["score"], 2) for k in held}) == 3 and got[held[2]]["score"] < min(got[k]["score"] for k in held[:2])


def test_attention_gradients_and_windows():
    model, rng = attention_lm.AttentionModel(), np.random.default_rng(1)
    for name in model.p:
        model.p[name] = model.p[name].astype(np.float64)
    model.p["out"] = rng.normal(size=model.p["out"].shape) * 0.2
    x, y = rng.integers(0, 128, (3, 32)), rng.integers(0, 128, (3, 32))
    weight = (rng.random((3, 32)) < 0.7).astype(float)
    _, slopes = model.gradients(x, y, weight)
    for name, values in model.p.items():
        at = tuple(rng.integers(0, n) for n in values.shape) if name != "tokens" else (x[0, 3], 2)
        step = 1e-5
        values[at] += step
        up, _ = model.gradients(x, y, weight)
        values[at] -= 2 * step
        down, _ = model.gradients(x, y, weight)
        values[at] += step
        assert slopes[name][at] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-8)
    # Each token is scored once, and probabilities of groups add up to 1.
    tables = attention_lm.AttentionModel().tables()
    groups = rng.integers(0, 127, 100)
    bounds = np.array([0, 0, 10, 31, 100])
    whole = attention_lm.group_scores(tables, groups, bounds)
    parts = [attention_lm.group_scores(tables, groups[a:b], np.array([0, b - a]))[0] for a, b in zip(bounds, bounds[1:], strict=False)]
    assert whole == pytest.approx(parts, rel=1e-5)
    first = [attention_lm._half_scores(tables, np.full((1, 32), 128), np.full((1, 32), g), True)[0, 0] for g in range(128)]
    assert sum(10.0 ** s for s in first) == pytest.approx(1, rel=1e-4)


def test_attention_logits_beyond_the_range_of_exp():
    # Ordinary rows stay as they are; in far ones the largest visible value is taken off.
    rng = np.random.default_rng(3)
    plain = rng.normal(size=(4, 128)).astype(np.float32) * 8
    assert (attention_lm._in_range(plain.copy()) == plain).all()
    far = plain.copy()
    far[1] += 500
    far[2] -= 500
    found = attention_lm._in_range(far.copy())
    assert (found[[0, 3]] == plain[[0, 3]]).all()
    assert (found[1:3] == far[1:3] - far[1:3].max(axis=1, keepdims=True)).all()
    mask = np.triu(np.full((3, 3), -1e9, dtype=np.float32), 1)
    seen = attention_lm._in_range(np.array([[1, 300, 300], [-200, -300, 5], [7, 8, 9]], dtype=np.float32), mask)
    assert seen[0, 0] == 1 and seen[1, :2].tolist() == [0, -100] and seen[2].tolist() == [7, 8, 9]
    assert (seen[[0, 0, 1], [1, 2, 2]] < -1e8).all()
    # Loss, gradients and scores of a model with such logits are those of double precision.
    model = attention_lm.AttentionModel()
    model.p["out"] = rng.normal(size=model.p["out"].shape).astype(np.float32) * 200
    model.p["query"] *= 600
    x, y, weight = rng.integers(0, 128, (5, 32)), rng.integers(0, 127, (5, 32)), np.ones((5, 32), dtype=np.float32)
    _, slopes = model.gradients(x, y, weight)
    assert all(np.isfinite(g).all() for g in slopes.values())
    p = {n: v.astype(np.float64) for n, v in model.p.items()}
    e = p["tokens"][x] + p["place"]
    a = (e @ p["query"]) @ (e @ p["key"]).transpose(0, 2, 1) / 4 + np.triu(np.full((32, 32), -np.inf), 1)
    assert np.abs(a[np.isfinite(a)]).max() > attention_lm.LIMIT
    a = np.exp(a - a.max(axis=2, keepdims=True))
    logits = (e + a / a.sum(axis=2, keepdims=True) @ (e @ p["value"]) @ p["mix"]) @ p["out"] + p["bias"]
    top = logits.max(axis=2, keepdims=True)
    assert top.max() > attention_lm.LIMIT
    wanted = (logits - top - np.log(np.exp(logits - top).sum(axis=2, keepdims=True))) / np.log(10)
    wanted = np.take_along_axis(wanted, y[..., None], axis=2)[..., 0]
    tables = model.tables()
    assert attention_lm._half_scores(tables, x, y, True) == pytest.approx(wanted[:, :16], rel=1e-3, abs=1e-3)
    assert attention_lm._half_scores(tables, x, y, False) == pytest.approx(wanted[:, 16:], rel=1e-3, abs=1e-3)


def test_distinct_words_of_a_block():
    rng = np.random.default_rng(4)
    for values in (rng.integers(0, 50, 1000), rng.integers(0, 1 << 62, 300), np.zeros(0)):
        values = values.astype(np.uint64) * np.uint64(3)
        for found, wanted in zip(
            attention_lm._distinct(values), np.unique(values, return_index=True, return_inverse=True), strict=True
        ):
            assert found.tolist() == wanted.tolist()


def test_every_word_of_a_text_is_learned_from(spark):
    def learned(words):
        model = attention_lm.AttentionModel()
        docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
        attention_lm.learn_everywhere(docs, model, packing.default_vocabulary())
        return model.flat()

    words = ["one", "two"] * 1000
    plain = learned(words)
    for place in (0, 500, 1000, 1500, 1999):
        assert (learned([*words[:place], "six", *words[place + 1 :]]) != plain).any(), place


@settings(max_examples=40, deadline=None)
@given(counts=st.lists(st.integers(0, 100), min_size=1, max_size=6), batch=st.integers(1, 5))
def test_whole_windows(counts, batch):
    bounds = np.cumsum([0, *counts])
    groups = np.arange(bounds[-1]) % 127
    parts = attention_lm.whole_windows(groups, bounds, batch)
    found = [pair for x, y, w in parts for pair in zip(x[w > 0].tolist(), y[w > 0].tolist(), strict=True)]
    texts = [groups[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert found == [pair for t in texts for pair in zip([attention_lm.START, *t], [*t, attention_lm.END], strict=True)]


# Personal data


PII_ALPHABET = "a.@-+0123456789 ()_xé"


def _brute_pii(text):
    spans = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    spans += [("ip", m) for m in ips if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    spans += [("card", m) for m in cards if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    spans += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return sorted(((k, *m.span()) for k, m in spans), key=lambda s: (s[1], pii.BASE.index(s[0])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=PII_ALPHABET, max_size=60))
def test_base_spans(text):
    assert pii.find(text)[0] == _brute_pii(text)


def test_personal_data(spark, sf_dir, texts):
    for r in all_queries()["op8_personal_data"](spark, sf_dir).collect():
        base = _brute_pii(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in base) for k in pii.BASE]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_added_spans():
    text = "IBAN: DE89 3704 0044 0532 0130 00 or https://me:secret@host.org/x, account no. 12345678, 4111 1111 1111 1111"
    base, spans = pii.find(text)
    found = {kind: text[a:b] for kind, a, b in spans}
    assert found["iban"] == "DE89 3704 0044 0532 0130 00" and found["login"] == "me:secret"
    assert found["account"] == "12345678" and found["card"] == "4111 1111 1111 1111"
    assert set(base) <= set(spans)
    assert pii.find("IBAN DE89 3704 0044 0532 0130 01")[1] == []
    assert "secret" not in pii.redacted(text, ",".join(f"{k}:{a}:{b}" for k, a, b in spans))
    assert luhn_cases()


def luhn_cases():
    return pii.luhn("79927398713") and not pii.luhn("79927398710")


# Vectors


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(30, 16))
    x = np.concatenate([base, *(base[:10] + rng.normal(size=(10, 16)) * s for s in (0.05, 0.2, 0.3, 0.5)), base[:3], 2 * base[3:5]])
    x = x.astype(np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.where(near, label[None, :], len(x)).min(axis=1)
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.near_vectors(rows).collect()}
    assert got == {k: (int(near[k].sum()) - 1, int(label[k]), bool(label[k] == k)) for k in range(len(x))}


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 8)
    rng = np.random.default_rng(2)
    x = rng.normal(size=8)[None, :] + rng.normal(size=(60, 8)) * 0.05
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(r["n_links"], r["component_id"]) for r in embed_dedup.near_vectors(rows).collect()}
    assert got == {(59, 0)}


@pytest.mark.parametrize("k", [1, 2, 3])
def test_recall_at_the_threshold(k):
    rng = np.random.default_rng(k)
    a = rng.normal(size=(600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r = rng.normal(size=a.shape)
    r -= (r * a).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + math.sqrt(1 - 0.81) * r / np.linalg.norm(r, axis=1, keepdims=True)
    tables = embed_dedup.tables_for(k)
    x, y = (embed_dedup.bucket_codes(embed_dedup.nearest_axes(v, k, tables), 128) for v in (a, b))
    meet = (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3))
    assert meet.mean() > 0.97


# SQL


def test_queries_match_sql(spark, sf_dir):
    import duckdb

    from barsieve.llm.queries import all_sql

    sql = duckdb.connect()
    for name in ("documents", "labels", "embeddings"):
        sql.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    for name, text in all_sql().items():
        found = sql.execute(text)
        names = [d[0] for d in found.description]
        want = sorted(repr(tuple(r)) for r in found.fetchall())
        got = sorted(repr(tuple(r)) for r in all_queries()[name](spark, sf_dir).select(*names).collect())
        assert got == want, name


def test_pages_query_matches_sql(spark, tmp_path):
    import duckdb

    from barsieve.llm.queries import pages_sql

    rows = [(k, f"u{k}", (None, "", "<p>a</p>", f"<p>é{k % 5}</p>")[k % 4]) for k in range(40)] + [(3, "u3", "again")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    sql = duckdb.connect()
    sql.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    for name, text in pages_sql().items():
        found = sql.execute(text)
        names = [d[0] for d in found.description]
        want = sorted(repr(tuple(r)) for r in found.fetchall())
        got = sorted(repr(tuple(r)) for r in all_queries()[name](spark, str(tmp_path)).select(*names).collect())
        assert got == want and got, name


def test_vocabularies_agree():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rng = random.Random(6)
    for _ in range(200):
        text = "".join(rng.choice("ab Ç\n\t'sé中0123 .,!\U0001f600<|endoftext|>") for _ in range(rng.randrange(80)))
        want = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert packing.token_ids(packing.default_vocabulary(), text).tolist() == want
    assert base64.b64decode("YQ==") == b"a"


def test_added_tokens_in_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(8)
    parts = ["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "a", "one two", "é中", "'s", "12", "."]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        want = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert packing.token_ids(packing.default_vocabulary(), text).tolist() == want, text
    assert 50256 in packing.token_ids(packing.default_vocabulary(), "a<|endoftext|>b")
