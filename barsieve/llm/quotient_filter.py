"""A counting quotient filter that loses nothing: keys of a known width with their counts, in a few bytes each.

Keys are spread by an invertible permutation of their width. The first bits of a permuted key are its quotient, the
others its remainder, which is kept in full, so that a filter holds keys themselves and none is taken for another. A
filter has a row of bits, in which every quotient has as many ones as there are keys with it and then a zero, the
remainders in order in as few bytes as hold them, and a counter of one byte a key; larger counts stand at the end.
Filters of the same width are in the same order, so they merge as sorted lists do.
"""

from __future__ import annotations

import numpy as np

from barsieve.llm.textblocks import U64

_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_HEAD = np.dtype([("keys", "<u8"), ("bits", "u1"), ("quotient_bits", "u1")])
_MOST = 255


def permuted(keys: np.ndarray, bits: int) -> np.ndarray:
    """Keys below 2**bits spread over that range; one to one."""
    half, mask = U64((bits + 1) // 2), U64((1 << bits) - 1)
    x = keys.astype(U64)
    for odd in _ODD:
        x ^= x >> half
        x = (x * U64(odd)) & mask
    return x ^ (x >> half)


def unpermuted(values: np.ndarray, bits: int) -> np.ndarray:
    """The keys that `permuted` has spread."""
    half, mask = U64((bits + 1) // 2), U64((1 << bits) - 1)
    x = values ^ (values >> half)
    for odd in reversed(_ODD):
        x = (x * U64(pow(odd, -1, 1 << 64))) & mask
        x ^= x >> half
    return x


def pack(values: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter of distinct permuted keys below 2**bits, in order, and their counts."""
    n = len(values)
    quotient_bits = min(bits, max(0, n - 1).bit_length())
    rest = U64(bits - quotient_bits)
    runs = np.zeros(n + (1 << quotient_bits), dtype=np.uint8)
    runs[(values >> rest).astype(np.int64) + np.arange(n)] = 1
    width = -(-int(rest) // 8)
    remainders = (values & ((U64(1) << rest) - U64(1))).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
    small = np.minimum(counts, _MOST).astype(np.uint8)
    head = np.array([(n, bits, quotient_bits)], dtype=_HEAD)
    large = counts[counts >= _MOST].astype("<i8")
    parts = [head, np.packbits(runs, bitorder="little"), np.ascontiguousarray(remainders), small, large]
    return b"".join(p.tobytes() for p in parts)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The permuted keys of a filter, in order, and their counts."""
    head = np.frombuffer(packed, dtype=_HEAD, count=1)[0]
    n, quotient_bits = int(head["keys"]), int(head["quotient_bits"])
    rest = int(head["bits"]) - quotient_bits
    slots, width = n + (1 << quotient_bits), -(-rest // 8)
    at = _HEAD.itemsize
    raw = np.frombuffer(packed, dtype=np.uint8)
    end = at + -(-slots // 8)
    runs = np.unpackbits(raw[at:end], count=slots, bitorder="little")
    quotients = (np.flatnonzero(runs) - np.arange(n)).astype(U64)
    at, end = end, end + n * width
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :width] = raw[at:end].reshape(n, width)
    remainders = wide.view("<u8").reshape(n).astype(U64)
    counts = raw[end : end + n].astype(np.int64)
    counts[counts == _MOST] = np.frombuffer(packed, dtype="<i8", offset=end + n)
    values = remainders if rest >= 64 else (quotients << U64(rest)) | remainders
    return values, counts


def merged(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Unpacked filters as one: keys in order, sums of their counts, and where each filter's keys are in it."""
    values = np.concatenate([v for v, _ in filters])
    counts = np.concatenate([c for _, c in filters])
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    fresh = np.ones(len(ordered), dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(fresh)
    sums = np.add.reduceat(counts[order], starts) if len(starts) else counts
    place = np.empty(len(ordered), dtype=np.int64)
    place[order] = np.cumsum(fresh) - 1
    return ordered[fresh], sums, np.split(place, np.cumsum([len(v) for v, _ in filters])[:-1])
