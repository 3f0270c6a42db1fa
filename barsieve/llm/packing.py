"""Packing tokenised documents into fixed-length sequences by first-fit decreasing.

A document is its token ids and one end id. It is cut into pieces of `length` ids and a rest. Pieces are dealt at
random, by a seeded hash, into groups of about `GROUP` pieces; within a group they go, longest first, into the first
sequence with room. A tournament tree holds the room of every sequence, with the larger of two at each inner node,
so the first one with enough room is found from the root down.

A null text is an empty one, and an empty text is one piece: its end id. Repeated rows are documents of their own. An
empty table gives an empty table. No id is dropped. Only ids' counts and checksums leave the tokenising tasks.
"""

from __future__ import annotations

import base64
import json
import math
import zlib
from collections import Counter
from functools import cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsieve.llm.common import map_blocks, staged

LENGTH, END, SEED = 1024, 0, 30
#: Pieces in a group, on average.
GROUP = 8192
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def default_vocabulary() -> str:
    """Ranks of the 50k byte-level vocabulary; its ids are those of byte_bpe_50k.json."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def encoder(path: str):
    """The byte-level tokenizer of a file of ranks, with the added tokens of the JSON file beside it, if there is one."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    whole = Path(path).with_suffix(".json")
    added = json.loads(whole.read_text(encoding="utf-8"))["added_tokens"] if whole.exists() else []
    special = {t["content"]: t["id"] for t in added}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(path: str, text: str | None) -> np.ndarray:
    """The ids of a text and the end id, as unsigned 32-bit numbers; an added token that stands in the text has its id."""
    ids = encoder(path).encode_to_numpy(text, allowed_special="all") if text else np.zeros(0, dtype="<u4")
    return np.concatenate([ids.astype("<u4", copy=False), np.array([END], dtype="<u4")])


def pieces(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None) -> DataFrame:
    """A row for each piece: `doc_id`, `start`, `length`, `ids_crc32`, `doc_tokens`."""
    return _numbered_pieces(docs, length, vocabulary).drop("copy")


def _numbered_pieces(docs: DataFrame, length: int, vocabulary: str | None) -> DataFrame:
    """The pieces with `copy`: how many rows before in the same block of texts have the doc_id; 0 where it is unique."""
    path = vocabulary or default_vocabulary()

    def cut(block: pa.RecordBatch) -> dict[str, object]:
        rows: list[tuple[int, int, int, int, int, int]] = []
        seen: Counter[int | None] = Counter()
        for doc_id, text in zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist(), strict=True):
            ids = token_ids(path, text)
            for start in range(0, len(ids), length):
                part = ids[start : start + length]
                rows.append((doc_id, start, len(part), zlib.crc32(part), len(ids), seen[doc_id]))
            seen[doc_id] += 1
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "copy")
        return dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else {n: [] for n in names}

    return map_blocks(docs.select("doc_id", "text"), cut, f"{PIECE}, copy long")


class RoomTree:
    """Sequences of equal capacity under a tournament tree: which is the first with enough room?"""

    def __init__(self, sequences: int, capacity: int):
        self.leaves = 1 << max(0, math.ceil(math.log2(max(1, sequences))))
        self.room = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """Take room for a piece; the sequence and the room it had before."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            at += room[at] < length
        found, before = at - self.leaves, room[at]
        room[at] -= length
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
        return found, before


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For pieces, longest first, the sequence of each and its place in it."""
    tree = RoomTree(len(lengths), capacity)
    placed = [tree.place(n) for n in lengths.tolist()]
    sequence, before = np.array(placed, dtype=np.int64).reshape(-1, 2).T
    return sequence, capacity - before


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None, seed: int = SEED) -> DataFrame:
    """The pieces with the `sequence_id` each goes to and its `offset` there."""
    cut = staged(_numbered_pieces(docs, length, vocabulary), "pieces")
    groups = max(1, math.ceil(cut.count() / GROUP))
    order = ["length", "doc_id", "start", "ids_crc32"]

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, ascending=[False, True, True, True], kind="stable")
        sequence, offset = first_fit_decreasing(rows["length"].to_numpy(), length)
        return rows.assign(sequence_id=(rows["group"].to_numpy() << 32) | sequence, offset=offset).drop(columns=["group", "copy"])

    # repeated rows are dealt like others, by their numbers
    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", "copy"), F.lit(groups))
    placed = f"{PIECE}, sequence_id long, offset long"
    return cut.withColumn("group", group).groupBy("group").applyInPandas(fill, placed)
