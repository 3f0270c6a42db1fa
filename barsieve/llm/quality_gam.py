"""Quality classifier: an additive model of text statistics with pairwise terms, learned by cyclic boosting.

Every statistic is cut into at most 64 bins; boosting goes round the statistics, fits a tree of at most four leaves
to the gradient over one statistic's bins and adds it to that statistic's lookup table. Pairs of statistics with the
largest remaining gain get tables of their own in the same way. A score is a sum of table entries, taken for a whole
block of texts at once.

Null and empty texts have the statistics of a text without words and get a score like any other. Without labelled
rows, or with one class only, every score is the share of label 1 (0.5 without any). Repeated rows are scored one
by one; other columns are carried along, and an input column named like a new one is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsieve.llm.common import add_columns
from barsieve.llm.textblocks import TextBlock, distinct_in_rows, windows

#: Labelled rows to learn from, at most. More labelled rows are thinned by a hash of doc_id.
MAX_TRAINING_ROWS = 20_000
THRESHOLD = 0.3
FEATURES = (
    "words", "word_bytes", "symbols", "exclamations", "capitals", "lone_marks", "digits", "line_words",
    "distinct_words", "repeated_lines", "short_words", "beyond_ascii", "stops", "repeated_runs",
)


def _class_table(chars: str | range) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[ord(c) for c in chars] if isinstance(chars, str) else list(chars)] = True
    return table


_SYMBOLS = _class_table("#*$%&|<>{}[]\\^~=_@")
_UPPER, _ALPHA = _class_table(range(65, 91)), _class_table([*range(65, 91), *range(97, 123)])
_DIGITS, _HIGH, _STOPS = _class_table(range(48, 58)), _class_table(range(128, 256)), _class_table(".,;:?")


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text."""
    block = TextBlock(texts)
    words, lines = block.words, block.lines
    n_words = words.counts
    n_bytes = np.diff(block.offsets)
    some_words, some_bytes = np.maximum(n_words, 1), np.maximum(n_bytes, 1)
    length = words.end - words.start
    by_row = lambda flags: np.bincount(words.row, weights=flags, minlength=block.rows)
    share = lambda table: block.per_row(table[block.data]) / some_bytes
    alpha = np.maximum(block.per_row(_ALPHA[block.data]), 1)
    _, distinct = distinct_in_rows(block.word_hashes, words.bounds)
    runs, cuts = windows(block.word_hashes, words.bounds, 5)
    _, distinct_runs = distinct_in_rows(runs, cuts)
    _, distinct_lines = distinct_in_rows(block.hashes(lines.start, lines.end), lines.bounds)
    marks = (length == 1) & ~_ALPHA[block.data[words.start]] & ~_DIGITS[block.data[words.start]]
    return np.column_stack(
        [
            np.log1p(n_words),
            by_row(length) / some_words,
            share(_SYMBOLS),
            block.per_row(block.data == ord("!")) / some_bytes,
            block.per_row(_UPPER[block.data]) / alpha,
            by_row(marks) / some_words,
            share(_DIGITS),
            np.log1p(n_words / lines.counts),
            np.diff(distinct) / some_words,
            1 - np.diff(distinct_lines) / lines.counts,
            by_row(length <= 3) / some_words,
            share(_HIGH),
            share(_STOPS),
            1 - np.diff(distinct_runs) / np.maximum(np.diff(cuts), 1),
        ]
    )


@dataclass
class AdditiveModel:
    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(self.cuts)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        if self.tables:
            at = self.bins(x)
            for table, b in zip(self.tables, at, strict=True):
                total += table[b]
            for i, j, table in self.pairs:
                total += table[at[i], at[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _leaf(g: np.ndarray | float, h: np.ndarray | float) -> np.ndarray | float:
    return g / (h + 1.0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Values by bin of a tree with so many leaves, best cut first."""
    parts = [(0, len(g))]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    for _ in range(leaves - 1):
        best = (1e-9, 0, 0)
        for k, (a, b) in enumerate(parts):
            if b - a > 1:
                m = np.arange(a + 1, b)
                gl, hl, gr, hr = cg[m] - cg[a], ch[m] - ch[a], cg[b] - cg[m], ch[b] - ch[m]
                gains = _gain(gl, hl) + _gain(gr, hr) - _gain(gl + gr, hl + hr)
                top = int(np.argmax(gains))
                best = max(best, (float(gains[top]), k, int(m[top])))
        if not best[2]:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(cg[b] - cg[a], ch[b] - ch[a])
    return out


def _cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values by cell of the best tree that cuts both axes once."""
    sums = [np.zeros((g.shape[0] + 1, g.shape[1] + 1)) for _ in range(2)]
    for s, v in zip(sums, (g, h), strict=True):
        s[1:, 1:] = v.cumsum(0).cumsum(1)
    (cg, ch), total = sums, 0
    quads = []
    for rows, cols in ((0, 0), (0, 1), (1, 0), (1, 1)):
        part = []
        for c in (cg, ch):
            inner = c[1:-1, 1:-1]
            left = c[1:-1, -1:] if cols else inner
            v = left - inner if cols else inner
            if rows:
                whole = c[-1:, -1:] - c[-1:, 1:-1] if cols else c[-1:, 1:-1]
                v = whole - v
            part.append(v)
        quads.append(part)
        total = total + _gain(*part)
    total = total - _gain(cg[-1, -1], ch[-1, -1])
    at = np.unravel_index(int(np.argmax(total)), total.shape)
    out = np.zeros(g.shape)
    for (rows, cols), (qg, qh) in zip(((0, 0), (0, 1), (1, 0), (1, 1)), quads, strict=True):
        r = slice(at[0] + 1, None) if rows else slice(0, at[0] + 1)
        c = slice(at[1] + 1, None) if cols else slice(0, at[1] + 1)
        out[r, c] = _leaf(qg[at], qh[at])
    return float(total[at]), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, rate: float = 0.1) -> AdditiveModel:
    """Cyclic boosting over single statistics, then over the five pairs with the largest remaining gain."""
    if not len(y) or y.min() == y.max():
        p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        return AdditiveModel(float(np.log(p / (1 - p))), [], [], [])
    p = y.mean()
    levels = np.linspace(0, 1, 65)[1:-1]
    cuts = [np.unique(np.quantile(x[:, k], levels)) for k in range(x.shape[1])]
    model = AdditiveModel(float(np.log(p / (1 - p))), cuts, [np.zeros(len(c) + 1) for c in cuts], [])
    at = model.bins(x)
    total = np.full(len(y), model.intercept)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-total))
        return y - q, q * (1 - q)

    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            if len(table) > 1:
                g, h = gradients()
                step = rate * _shallow_tree(*(np.bincount(at[k], v, len(table)) for v in (g, h)))
                table += step
                total += step[at[k]]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.tables[i]), len(model.tables[j])
        cell = at[i] * shape[1] + at[j]
        return tuple(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in gradients())

    wide = [k for k, t in enumerate(model.tables) if len(t) > 1]
    gains = sorted(((_cross_tree(*grid(i, j))[0], i, j) for i in wide for j in wide if i < j), reverse=True)
    model.pairs = [(i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))) for _, i, j in gains[:5]]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            step = rate * _cross_tree(*grid(i, j))[1]
            table += step
            total += step[at[i], at[j]]
    return model


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, limit: int) -> DataFrame:
    """Texts with the labels to learn from: about `limit` rows at most, spread by a hash of doc_id.

    Labels that are given several times count once, and of rows that share a doc_id the smallest text.
    """
    usable = labels.where(learn & F.col("quality").isNotNull()).select("doc_id", F.col("quality").alias("label")).distinct()
    share = min(1.0, limit / max(1, usable.count()))
    spread = F.pmod(F.xxhash64(F.lit("training"), "doc_id"), F.lit(1 << 20))
    chosen = usable.where(spread < int(share * (1 << 20)))
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by `limit`
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, learn: Column, limit: int = MAX_TRAINING_ROWS) -> AdditiveModel:
    """Learn from the labelled rows for which `learn` holds; at most about `limit` rows come to the driver."""
    names = [f"f{k}" for k in range(len(FEATURES))]

    def measure(block: pa.RecordBatch) -> dict[str, object]:
        return dict(zip(names, features(block.column("text")).T, strict=True))

    rows = training_rows(docs, labels, learn, limit)
    table = add_columns(rows, measure, ", ".join(f"{n} double" for n in names), ["doc_id", "label"])
    found = table.orderBy("doc_id", *names).toPandas()
    return fit(found[names].to_numpy(), found["label"].to_numpy().astype(float))


def score(docs: DataFrame, model: AdditiveModel, keep: list[str] | None = None) -> DataFrame:
    """The rows with `score`, 0 to 1: higher where label 1 is likelier."""
    return add_columns(docs, lambda block: {"score": model.score(features(block.column("text")))}, "score double", keep)


def classify(
    docs: DataFrame, corpus: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = THRESHOLD,
    keep: list[str] | None = None,
) -> DataFrame:
    """Score `docs` by what was learned from the labelled rows of `corpus` outside fold 0; a null id learns nothing."""
    model = train(corpus, labels, fold(F.col("doc_id"), folds) != 0)
    return score(docs, model, keep).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
