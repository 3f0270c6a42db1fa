"""Quality rules: fixed counts, and a calibrated logistic regression on hashed word and character n-grams.

The counts fail a text with under `MIN_WORDS` words, or with more than `MOST_REPEATED` per cent of its words in runs
of five that the text holds twice or more. Any other text is kept if the probability of label 1 is `KEEP_AT` or more.

The regression sees the shares of a text's words, of its pairs of neighbouring words and of its trigrams of characters
(code points) by hash, and is fitted on labelled rows; one row in five of them, by a hash, is left out of the fit and sets the slope and offset that turn a sum into a
probability. Null and empty texts have no words and fail. Without labelled rows, or with one class only, every text
that passes the counts is kept. Repeated rows are judged one by one; other columns are carried along, and an input
column named like a new one is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsieve.llm.common import add_columns
from barsieve.llm.quality_gam import training_rows
from barsieve.llm.textblocks import U64, TextBlock, mix, windows

#: Labelled rows to learn from, at most. More are thinned by a hash of doc_id.
MAX_TRAINING_ROWS = 4000
#: Slots of words, of word pairs and of trigrams; powers of two.
SLOTS = (1 << 10, 1 << 11, 1 << 11)
MIN_WORDS, MOST_REPEATED, RUN = 10, 20, 5
KEEP_AT = 0.5
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _repeats(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each value, 0 if its row holds it once, 1 where it first stands, 2 where it stands again."""
    order = np.lexsort((values, rows))  # stable: equal values stay in place order
    v, r = values[order], rows[order]
    again = np.zeros(len(v), dtype=bool)
    again[1:] = (v[1:] == v[:-1]) & (r[1:] == r[:-1])
    first = np.zeros(len(v), dtype=bool)
    first[:-1] = again[1:] & ~again[:-1]
    out = np.zeros(len(v), dtype=np.int8)
    out[order] = first + 2 * again
    return out


def counts(block: TextBlock) -> dict[str, np.ndarray]:
    """The fixed counts of each text."""
    words, lines = block.words, block.lines
    n_words = words.counts
    in_words = np.zeros(len(block.data) + 1, dtype=np.int32)
    np.add.at(in_words, words.start, 1)
    np.add.at(in_words, words.end, -1)
    heads = (block.data & 0xC0) != 0x80  # a character's first byte
    word_chars = block.per_row((np.cumsum(in_words[:-1]) > 0) & heads)
    with_word = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    line_rows = lines.row[with_word]
    seen = _repeats(block.hashes(lines.start[with_word], lines.end[with_word]), line_rows)
    runs, cuts = windows(block.word_hashes, words.bounds, RUN)
    run_rows = np.repeat(np.arange(block.rows), np.diff(cuts))
    at = np.flatnonzero(_repeats(runs, run_rows))
    starts = at + (words.bounds[:-1] - cuts[:-1])[run_rows[at]]
    covered = np.zeros(len(words) + 1, dtype=np.int32)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + RUN, -1)
    covered = np.cumsum(covered[:-1]) > 0
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": block.per_row(_SYMBOLS[block.data]),
        "n_dup_lines": np.bincount(line_rows[seen == 2], minlength=block.rows),
        "n_repeat_words": np.bincount(words.row[covered], minlength=block.rows),
    }


def _trigrams(block: TextBlock) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every three characters in a row of the block, and the places of each text's characters among them."""
    heads = (block.data & 0xC0) != 0x80
    begins = np.concatenate([[0], np.cumsum(heads)])[block.offsets]
    c = np.frombuffer(block.data.tobytes().decode().encode("utf-32-le"), dtype="<u4").astype(U64)
    key = (c[:-2] << U64(42)) | (c[1:-1] << U64(21)) | c[2:] if len(c) > 2 else np.zeros(0, dtype=U64)
    return mix(key), begins


def _grams(block: TextBlock) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For words, word pairs and trigrams: the slot of each, and the first and end place of each text's."""
    pairs, cuts = windows(block.word_hashes, block.words.bounds, 2)
    trigrams, begins = _trigrams(block)
    ends = np.maximum(begins[1:] - 2, begins[:-1])
    places = [(block.words.bounds[:-1], block.words.bounds[1:]), (cuts[:-1], cuts[1:]), (begins[:-1], ends)]
    hashes = [block.word_hashes, pairs, trigrams]
    return [((h & U64(n - 1)).astype(np.int64), a, b) for h, n, (a, b) in zip(hashes, SLOTS, places, strict=True)]


def shares(block: TextBlock) -> np.ndarray:
    """For each text, the shares of its words, word pairs and trigrams by slot."""
    out = np.zeros((block.rows, sum(SLOTS)), dtype=np.float32)
    first = 0
    for (slots, start, end), size in zip(_grams(block), SLOTS, strict=True):
        for k, (a, b) in enumerate(zip(start, end, strict=True)):
            out[k, first : first + size] = np.bincount(slots[a:b], minlength=size) / max(1, b - a)
        first += size
    return out


@dataclass
class NgramModel:
    """Weights by slot; a probability is the logistic of slope * (sum of weighted shares + bias) + offset."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, block: TextBlock) -> np.ndarray:
        total, first = np.full(block.rows, self.bias), 0
        for (slots, start, end), size in zip(_grams(block), SLOTS, strict=True):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[first + slots])])
            total += (sums[end] - sums[start]) / np.maximum(end - start, 1)
            first += size
        return _logistic(self.slope * total + self.offset)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def calibrate(total: np.ndarray, y: np.ndarray, steps: int = 30) -> tuple[float, float]:
    """Slope and offset of the logistic that fits smoothed labels best, by damped Newton steps."""
    centre, width = total.mean(), max(float(total.std()), 1e-9)
    x = np.column_stack([(total - centre) / width, np.ones(len(total))])
    ones = y.sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float((np.logaddexp(0, z) - target * z).sum())

    at = np.zeros(2)
    for _ in range(steps):
        p = _logistic(x @ at)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (target - p))
        while loss(at + step) > loss(at) and np.abs(step).max() > 1e-9:
            step = step / 2
        at = at + step
    slope = max(at[0], 1e-3) / width
    return float(slope), float(at[1] - slope * centre)


def fit(x: np.ndarray, y: np.ndarray, left_out: np.ndarray, steps: int = 200, ridge: float = 1e-3) -> NgramModel | None:
    """Logistic regression by accelerated gradient steps on scaled shares; None unless both classes are there."""
    train = ~left_out
    if train.sum() < 2 or y[train].min() == y[train].max():
        return None
    scale = 1 / np.sqrt(x[train].var(axis=0) + 1e-6)
    mean = x[train].mean(axis=0)
    z = ((x - mean) * scale).astype(np.float32)
    a, target = z[train], y[train].astype(np.float32)
    # Slots go together, so the step is that of the largest eigenvalue, estimated by power iteration.
    v = np.ones(z.shape[1], dtype=np.float32)
    for _ in range(8):
        v = a.T @ (a @ (v / np.linalg.norm(v)))
    rate = len(a) / (0.25 * float(np.linalg.norm(v)) + ridge * len(a))
    w = ahead = np.zeros(z.shape[1], dtype=np.float32)
    bias = float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    for k in range(steps):
        p = _logistic(a @ ahead + bias)
        new = ahead - rate * (a.T @ (p - target).astype(np.float32) / len(a) + ridge * ahead)
        ahead = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    weights = (w * scale).astype(np.float64)
    total = z @ w + bias
    held = left_out if left_out.sum() >= 20 and len(set(y[left_out])) == 2 else train
    slope, offset = calibrate(total[held].astype(np.float64), y[held])
    return NgramModel(weights, bias - float(mean @ weights), slope, offset)


def train(docs: DataFrame, labels: DataFrame, learn: Column, limit: int = MAX_TRAINING_ROWS) -> NgramModel | None:
    """Fit on the labelled rows for which `learn` holds; at most about `limit` rows come to the driver."""

    def measure(block: pa.RecordBatch) -> dict[str, object]:
        return {"shares": [row.astype(np.float16).tobytes() for row in shares(TextBlock(block.column("text")))]}

    rows = add_columns(training_rows(docs, labels, learn, limit), measure, "shares binary", ["doc_id", "label"])
    left_out = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(5)) == 0
    found = rows.withColumn("left_out", left_out).orderBy("doc_id", "shares").toPandas()
    if not len(found):
        return None
    x = np.frombuffer(b"".join(found["shares"]), dtype=np.float16).reshape(len(found), -1).astype(np.float32)
    return fit(x, found["label"].to_numpy().astype(float), found["left_out"].to_numpy())


def judge(docs: DataFrame, model: NgramModel | None, keep: list[str] | None = None) -> DataFrame:
    """The rows with the counts, `base_failed`, `probability` and `kept`."""

    def run(block: pa.RecordBatch) -> dict[str, object]:
        texts = TextBlock(block.column("text"))
        found = counts(texts)
        n, repeated = found["n_words"], found["n_repeat_words"]
        failed = (n < MIN_WORDS) | (100 * repeated > MOST_REPEATED * n)
        p = model.probability(texts) if model else np.ones(texts.rows)
        return found | {"base_failed": failed, "probability": p, "kept": ~failed & (p >= KEEP_AT)}

    added = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, probability double, kept boolean"
    )
    return add_columns(docs, run, added, keep)
