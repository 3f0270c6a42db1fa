"""Periodic runs: stretches of words that repeat with a period, and the text without their repeats.

A text is cut into words at ASCII white space. A run is a stretch of words with smallest period q, of `LEAST` words and
two periods or more, that neither neighbouring word extends. It is a maximal pair: two equal stretches, q words apart,
whose left neighbours differ and whose right neighbours differ. So runs are read off maximal pairs, and nothing is
extended word by word.

The suffixes of the texts of a block are sorted together by prefix doubling (a text never shares a rank with another),
and the common prefixes of neighbours give the tree of LCP intervals, which is gone through bottom-up. An interval of
`l` words keeps the places of its suffixes in order, in a list of one class while they all follow the same left word.
Joining two children, lists of one and the same class give nothing. Otherwise each place of the shorter list meets its
neighbours in the longer one, which are pairs if their left words differ, their distance q is at most `l`, and
q + l is `LEAST` or more. These constraints are exactly those of a run of q + l words; pairs further apart are never
listed. Only neighbours matter: a place between both ends of a pair would give the stretch a smaller period. Among pairs
of one stretch the smallest distance is its period. Intervals of fewer than `LEAST` / 2 words cannot hold runs, so
texts in which no such stretch recurs are not sorted at all.

A null or empty text, or one of white space, has no words and no runs; its collapsed text is empty. Every row is looked
at by itself, whatever its doc_id, so repeated rows have equal results and rows without a doc_id results like any other.
Input columns with the name of a new one are replaced, others are kept. A text is one task's work; memory is some 100
bytes for each of its words.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsieve.llm.common import WORD, add_columns
from barsieve.llm.textblocks import U64, TextBlock, mix, windows

#: Fewest words of a run.
LEAST = 12

ADDED = (
    "n_runs long, start long, length long, period long, exponent_milli long, "
    "runs array<struct<start: long, length: long, period: long>>, collapsed string"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def sorted_suffixes(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The places of `values` in the order of their suffixes, and the ranks by the first 1, 2, 4... values.

    `ends` has for each place the end of its text; values of different texts must differ.
    """
    n = len(values)
    order = np.argsort(values, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    ordered = values[order]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, known = [rank.astype(np.int32)], 1
    while True:
        first = rank[order]
        same = first[1:] == first[:-1]
        tied = np.zeros(n, dtype=bool)
        tied[1:] |= same
        tied[:-1] |= same
        slots = np.flatnonzero(tied)
        if not len(slots):
            return order, levels
        at = order[slots]
        inside = at + known < ends[at]
        then = np.zeros(len(at), dtype=np.int64)
        then[inside] = rank[at[inside] + known] + 1
        key = rank[at] * (n + 1) + then
        turn = np.argsort(key, kind="stable")
        at, key = at[turn], key[turn]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        order[slots] = at
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        levels.append(rank.astype(np.int32))
        known *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """How many values each suffix in order shares with the one before it."""
    a, b = order[:-1], order[1:]
    shared = np.zeros(len(order), dtype=np.int64)
    length = shared[1:]
    for power in reversed(range(len(levels))):
        x, y = a + length, b + length
        at = np.flatnonzero((x < ends[a]) & (y < ends[b]))
        equal = at[levels[power][x[at]] == levels[power][y[at]]]
        length[equal] += 1 << power
    return shared


class MaximalPairs:
    """Goes through LCP intervals bottom-up; `found` has the period of each stretch (start, end)."""

    def __init__(self, left: list[int], least: int):
        self.left = left
        self.least = least
        self.found: dict[tuple[int, int], int] = {}

    def tree(self, places: list[int], shared: list[int]) -> None:
        """Suffixes in order, of which each shares `shared` values with the one before it."""
        open_intervals: list[tuple[int, list[int], int | None]] = []
        places_of, of = [places[0]], self.left[places[0]]
        for place, length in zip(places[1:], shared[1:], strict=True):
            while open_intervals and open_intervals[-1][0] > length:
                above, held, held_of = open_intervals.pop()
                places_of, of = self._joined(held, held_of, places_of, of, above)
            if open_intervals and open_intervals[-1][0] == length:
                _, held, held_of = open_intervals.pop()
                places_of, of = self._joined(held, held_of, places_of, of, length)
            open_intervals.append((length, places_of, of))
            places_of, of = [place], self.left[place]
        while open_intervals:
            above, held, held_of = open_intervals.pop()
            places_of, of = self._joined(held, held_of, places_of, of, above)

    def _joined(
        self, x: list[int], x_of: int | None, y: list[int], y_of: int | None, length: int
    ) -> tuple[list[int], int | None]:
        """Two children's lists as one, in order, with its left word (None: several)."""
        if len(x) < len(y):
            x, x_of, y, y_of = y, y_of, x, x_of
        one_class = x_of is not None and x_of == y_of
        if not one_class:
            for place in y:
                k = bisect_left(x, place)
                if k:
                    self._pair(x[k - 1], place, length)
                if k < len(x):
                    self._pair(place, x[k], length)
        if len(y) == 1:
            insort(x, y[0])
        else:
            x.extend(y)
            x.sort()
        return x, x_of if one_class else None

    def _pair(self, a: int, b: int, length: int) -> None:
        distance = b - a
        if distance <= length and distance + length >= self.least and self.left[a] != self.left[b]:
            stretch = (a, b + length)
            self.found[stretch] = min(distance, self.found.get(stretch, distance))


def find_runs(values: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> dict[int, list[tuple[int, int, int]]]:
    """For each text that has runs: start, length and period of each, by start and period.

    `values` has a number for each word, equal for equal words, and `bounds` cuts them by text.
    """
    half = (least + 1) // 2
    hashes, cuts = windows(values, bounds, half)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(cuts))
    own = hashes ^ mix(row.astype(U64) + U64(1))
    order = np.argsort(own)
    again = own[order[1:]] == own[order[:-1]]
    rows = np.unique(row[order[1:][again]])
    if not len(rows):
        return {}
    sizes = np.diff(bounds)[rows]
    begins = np.concatenate([[0], np.cumsum(sizes)])
    text = np.repeat(np.arange(len(rows)), sizes)
    at = np.repeat(bounds[:-1][rows] - begins[:-1], sizes) + np.arange(begins[-1])
    kinds = np.unique(values[at], return_inverse=True)[1].reshape(-1)
    ends = begins[1:][text]
    places, levels = sorted_suffixes(kinds + text * (kinds.max() + 1), ends)
    shared = common_prefixes(places, levels, ends)
    left = np.empty(len(kinds), dtype=np.int64)
    left[1:] = kinds[:-1]
    left[begins[:-1]] = -1
    pairs = MaximalPairs(left.tolist(), least)
    deep = shared >= half
    heads = np.flatnonzero(deep & ~np.concatenate([[False], deep[:-1]])) - 1
    tails = np.flatnonzero(deep & ~np.concatenate([deep[1:], [False]])) + 1
    for a, b in zip(heads.tolist(), tails.tolist(), strict=True):
        pairs.tree(places[a:b].tolist(), shared[a:b].tolist())
    out: dict[int, list[tuple[int, int, int]]] = {}
    for (start, end), period in pairs.found.items():
        k = text[start]
        out.setdefault(int(rows[k]), []).append((int(start - begins[k]), end - start, period))
    for runs in out.values():
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False for each of n words that a run holds after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def with_runs(docs: DataFrame, keep: list[str] | None = None, least: int = LEAST) -> DataFrame:
    """All rows of `docs` (text) with their columns, or those in `keep`, and those of `ADDED`.

    `runs` has all runs by start, then period; `start`, `length`, `period` and `exponent_milli` (thousandths of a period,
    rounded down) are those of the longest, of the first one among equals, and null without runs. `collapsed` has the
    words, joined by single spaces, that no run holds after its first period.
    """

    def make(block: pa.RecordBatch) -> dict[str, object]:
        texts = TextBlock(block.column("text"))
        found = find_runs(texts.word_hashes, texts.words.bounds, least)
        runs = [found.get(k, []) for k in range(texts.rows)]
        collapsed = []
        for k, own in enumerate(runs):
            words = texts.data[texts.offsets[k] : texts.offsets[k + 1]].tobytes().split()
            if own:
                words = [w for w, stays in zip(words, kept_words(len(words), own).tolist(), strict=True) if stays]
            collapsed.append(b" ".join(words))
        best = [max(own, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None)) for own in runs]
        flat = [dict(zip(("start", "length", "period"), r, strict=True)) for own in runs for r in own]
        cuts = np.concatenate([[0], np.cumsum([len(own) for own in runs])]).astype(np.int32)
        return {
            "n_runs": [len(own) for own in runs],
            "start": [r[0] for r in best],
            "length": [r[1] for r in best],
            "period": [r[2] for r in best],
            "exponent_milli": [None if r[2] is None else 1000 * r[1] // r[2] for r in best],
            "runs": pa.ListArray.from_arrays(cuts, pa.array(flat, type=_RUN)),
            "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
        }

    return add_columns(docs, make, ADDED, keep)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The rows with their text replaced, in a tenth of them chosen by doc_id, by one that ends in a periodic stretch.

    With h = crc32(doc_id as text), g = floor(h / 10), n words and h a multiple of 10, word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). Other rows, and those without a doc_id or
    words, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    chosen = F.coalesce((h % 10 == 0) & (F.size(words) > 0), F.lit(False))

    def rewritten(of: Column) -> Column:
        """From a struct of the words, their number n, and g."""
        n, g = of["n"], of["g"]
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(places, lambda i: F.get(of["words"], i.cast("int"))), " ")

    parts = F.struct(words.alias("words"), F.size(words).cast("long").alias("n"), F.floor(h / 10).alias("g"))
    # a lambda over one struct, so that the words are cut once for a row
    text = F.element_at(F.transform(F.array(parts), rewritten), 1)
    return docs.withColumn("text", F.when(chosen, text).otherwise(F.col("text")))
