"""Words, lines and their hashes for a block of texts, as arrays over the block's bytes.

A text is UTF-8, so its ASCII bytes never stand inside another character; words and lines can be cut on bytes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
#: Odd, so that it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_STEP = U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    x = x ^ (x >> U64(30))
    x = x * _MIX1
    x = x ^ (x >> U64(27))
    x = x * _MIX2
    return x ^ (x >> U64(31))


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F))


@cache
def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


@cache
def _space() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


class _Powers:
    """Powers of the base and of its inverse, kept for the longest block so far."""

    up = np.ones(1, dtype=U64)
    down = np.ones(1, dtype=U64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            inverse = U64(pow(_BASE, -1, 1 << 64))
            for name, factor in (("up", U64(_BASE)), ("down", inverse)):
                steps = np.full(n, factor, dtype=U64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=U64))
        return cls.up, cls.down


@dataclass
class Spans:
    """Pieces of a block: first and end byte, and the row each belongs to; `bounds` cuts them by row."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


class TextBlock:
    """The texts of an Arrow array as one byte array; a null text is empty."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        if texts.null_count:
            texts = texts.fill_null("")
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        raw = np.frombuffer(texts.buffers()[1], dtype=width)[texts.offset : texts.offset + len(texts) + 1]
        offsets = raw.astype(np.int64) if len(raw) else np.zeros(1, dtype=np.int64)
        data = texts.buffers()[2]
        body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        self.data = body[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        if lower:
            self.data = _lower()[self.data]

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per byte over each row."""
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    @cached_property
    def words(self) -> Spans:
        if not len(self.data):
            return self._spans(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
        inside = ~_space()[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(self.data))]
        first[cuts] |= inside[cuts]
        last[cuts - 1] |= inside[cuts - 1]
        return self._spans(np.flatnonzero(first), np.flatnonzero(last) + 1)

    @cached_property
    def lines(self) -> Spans:
        """The pieces between line feeds; an empty text has one empty line."""
        feeds = np.flatnonzero(self.data == 10)
        owner = np.searchsorted(self.offsets, feeds, side="right") - 1
        start = np.concatenate([self.offsets[:-1], feeds + 1])
        end = np.concatenate([feeds, self.offsets[1:]])
        row_of = np.concatenate([np.arange(self.rows), owner])
        order = np.lexsort((start, row_of))
        start, row = start[order], row_of[order]
        end = end[np.lexsort((end, np.concatenate([owner, np.arange(self.rows)])))]
        return Spans(start, end, row, np.searchsorted(row, np.arange(self.rows + 1)))

    def _spans(self, start: np.ndarray, end: np.ndarray) -> Spans:
        bounds = np.searchsorted(start, self.offsets)
        return Spans(start, end, np.repeat(np.arange(self.rows), np.diff(bounds)), bounds)

    @cached_property
    def _prefix(self) -> np.ndarray:
        up, _ = _Powers.get(len(self.data) + 1)
        sums = np.empty(len(self.data) + 1, dtype=U64)
        sums[0] = 0
        np.cumsum(_byte_values()[self.data] * up[: len(self.data)], dtype=U64, out=sums[1:])
        return sums

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges: equal bytes give equal hashes, in any block."""
        _, down = _Powers.get(len(self.data) + 1)
        value = (self._prefix[end] - self._prefix[start]) * down[start]
        return mix(value + (end - start).astype(U64) * _STEP)

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.words.start, self.words.end)


def windows(values: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `size` consecutive values of a row, with the cuts by row; shorter rows have none."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    cuts = np.concatenate([[0], np.cumsum(counts)])
    if len(values) < size:
        return np.zeros(0, dtype=U64), cuts
    whole = len(values) - size + 1
    hashed = np.zeros(whole, dtype=U64)
    for k in range(size):
        hashed = (hashed + values[k : k + whole]) * _STEP
        hashed ^= hashed >> U64(29)
    at = np.repeat(bounds[:-1] - cuts[:-1], counts) + np.arange(cuts[-1])
    return mix(hashed[at]), cuts


def folded(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash of each row's whole sequence of values."""
    place = np.arange(len(values)) - np.repeat(bounds[:-1], np.diff(bounds))
    spread = mix(values + mix(place.astype(U64) + U64(1)))
    sums = np.concatenate([np.zeros(1, dtype=U64), np.cumsum(spread, dtype=U64)])
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(U64) * _STEP)


def row_sorted(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The values, sorted within each row."""
    out = values.copy()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        out[a:b].sort()
    return out


def distinct_in_rows(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, with the new cuts."""
    ordered = row_sorted(values, bounds)
    fresh = np.ones(len(ordered), dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    firsts = bounds[:-1][np.diff(bounds) > 0]
    fresh[firsts] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return ordered[fresh], kept[bounds]
