"""Suffix-array dedup: bytes covered by a string of `LENGTH` bytes that starts anywhere else too are taken out.

Texts are UTF-8 bytes, a null text is empty, and no string crosses documents. All strings are judged on the input.

Every string of LENGTH bytes has one anchor: the GRAM bytes in it with the smallest hash, the first of equal ones.
Starts that follow each other and share their anchor are one segment, so equal strings stand in segments whose
anchors are equal, and only those need to meet.

1. Segments are listed by anchor; anchors that stand once are done with.
2. Segments that are equal as a whole are repeated as a whole.
3. Where the segments of an anchor differ, one of each kind goes, with its bytes, to the task of the anchor. There the
   suffixes of all of them are sorted and their Burrows-Wheeler transform is taken. Intervals of suffixes that begin
   with the same string are extended to the left, breadth first: the first interval that ends at a place in the order
   tells the length of the prefix that the suffixes on both sides share, and lengths come in increasing order.
   After LENGTH rounds the places that no interval has ended at are those where LENGTH bytes or more are shared.
4. An anchor with more than `KINDS` differing segments is not sorted in one task: its strings are counted by 128 bits
   of hash over all tasks instead, which gives the same answer.

Counts of anchors and kinds are written before they are joined to the segments, so that Spark can split the partition
of a frequent one. A text is known by 128 bits of its hash, so copies of a text share their spans. Repeated rows are documents of their
own, and doc_ids may be null. Other columns are carried along, but for input columns
named t1, t2 or runs; one named like a new one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsieve.llm.common import add_columns, map_blocks, staged
from barsieve.llm.textblocks import U64, TextBlock, mix

LENGTH, GRAM = 400, 128
#: Differing segments of one anchor that one task sorts, at most. Bytes that a task sorts at a time, about.
KINDS, SORTED_BYTES = 4096, 1 << 20


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values that follow each other."""
    n = len(values) - width + 1
    whole = -(-len(values) // width) * width
    padded = np.full(whole, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    tiles = padded.reshape(-1, width)
    from_left = np.minimum.accumulate(tiles, axis=1).ravel()
    from_right = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(from_right[:n], from_left[width - 1 : width - 1 + n])


def segments(texts: pa.Array, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The segments of a block: `row`, `start` in the text, number of `starts`, `anchor` and hash of the `kind`."""
    block = TextBlock(texts)
    empty = {k: np.zeros(0, dtype=np.int64) for k in ("row", "start", "starts", "anchor", "kind")}
    if len(block.data) < length:
        return empty
    first = np.arange(len(block.data) - gram + 1)
    grams = block.hashes(first, first + gram)
    places = (grams & U64(0xFFFFFFFF00000000)) | first.astype(U64)
    least = _sliding_least(places, length - gram + 1)
    # Starts whose string ends within its text, and where a new anchor or text begins.
    row = np.repeat(np.arange(block.rows), np.diff(block.offsets))[: len(least)]
    at = np.flatnonzero(np.arange(len(least)) + length <= block.offsets[row + 1])
    if not len(at):
        return empty
    new = np.ones(len(at), dtype=bool)
    new[1:] = (least[at[1:]] != least[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
    head = np.flatnonzero(new)
    starts = np.diff(np.append(head, len(at)))
    begin = at[head]
    anchor = (least[begin] & U64(0xFFFFFFFF)).astype(np.int64)
    kind = mix(block.hashes(begin, begin + starts - 1 + length) + (anchor - begin).astype(U64) * U64(0x9E3779B97F4A7C15))
    return {
        "row": row[begin],
        "start": begin - block.offsets[row[begin]],
        "starts": starts,
        "anchor": grams[anchor].view(np.int64),
        "kind": kind.view(np.int64),
    }


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and each one's rank: equal keys have equal ranks."""
    order = np.argsort(keys)
    sorted_keys = keys[order]
    step = np.ones(len(keys), dtype=np.int64)
    step[0] = 0
    step[1:] = sorted_keys[1:] != sorted_keys[:-1]
    rank = np.empty(len(keys), dtype=np.int64)
    rank[order] = np.cumsum(step)
    return order, rank


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """The rotations of the data, sorted by their first `depth` bytes or more."""
    keys = np.zeros(len(data), dtype=U64)
    for k in range(8):
        keys = (keys << U64(8)) | np.roll(data, -k).astype(U64)
    order, rank = _ranks(keys)
    known = 8
    while known < depth and rank[order[-1]] < len(data) - 1:
        order, rank = _ranks((rank.astype(U64) << U64(32)) | np.roll(rank, -known).astype(U64))
        known *= 2
    return order


def shared_places(transform: np.ndarray, length: int) -> np.ndarray:
    """For each place in the order, whether the rotations before and after it share `length` bytes or more.

    `transform` holds the byte before each rotation, in the order. Place k lies between rotations k - 1 and k.
    """
    n = len(transform)
    by_byte = np.argsort(transform, kind="stable")
    back = np.empty(n, dtype=np.int64)  # where the rotation that begins one byte earlier stands
    back[by_byte] = np.arange(n)
    run = np.cumsum(np.concatenate([[0], transform[1:] != transform[:-1]]))  # equal bytes in a row
    block_of = transform[by_byte]
    open_places = np.ones(n + 1, dtype=bool)
    open_places[[0, n]] = False
    low, high = np.array([0]), np.array([n - 1])  # the interval of the empty string
    for _ in range(length):
        if not len(low):
            break
        plain = run[low] == run[high]
        new_low, new_high = [back[low[plain]]], [back[high[plain]]]
        a, b = low[~plain], high[~plain]
        if len(a):
            size = b - a + 1
            owner = np.repeat(np.arange(len(a)), size)
            inner = np.arange(size.sum()) + np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
            to = back[inner]
            if len(to) > n // 8:
                at = np.full(n, -1, dtype=np.int64)
                at[to] = owner
                to = np.flatnonzero(at >= 0)
                owner = at[to]
            else:
                order = np.argsort(to)
                to, owner = to[order], owner[order]
            cut = np.ones(len(to), dtype=bool)
            cut[1:] = (to[1:] != to[:-1] + 1) | (owner[1:] != owner[:-1]) | (block_of[to[1:]] != block_of[to[:-1]])
            new_low.append(to[cut])
            new_high.append(to[np.append(np.flatnonzero(cut)[1:] - 1, len(to) - 1)])
        low, high = np.concatenate(new_low), np.concatenate(new_high)
        fresh = open_places[high + 1]
        low, high = low[fresh], high[fresh]
        open_places[high + 1] = False
    return open_places


def repeated_starts(pieces: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece, where strings of `length` bytes start that also start elsewhere in the pieces."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    data = np.frombuffer(b"\xff".join([*pieces, b""]), dtype=np.uint8)  # no UTF-8 text has that byte
    order = suffix_order(data, length)
    shared = shared_places(data[order - 1], length)
    again = np.zeros(len(data), dtype=bool)
    again[order] = shared[:-1] | shared[1:]
    ends = np.cumsum(sizes + 1)
    return [np.flatnonzero(again[e - 1 - n : max(e - 1 - n, e - length)]) for n, e in zip(sizes, ends, strict=True)]


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and number of places of each run of places that follow each other."""
    if not len(places):
        return places, places
    head = np.flatnonzero(np.concatenate([[True], np.diff(places) > 1]))
    return places[head], np.diff(np.append(head, len(places)))


MARK = "t1 long, t2 long, start long, starts long"


def _sorted_marks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Marks of the segments that stand once; rows come sorted by anchor and kind."""
    held: list[tuple] = []
    size = 0

    def result() -> pa.RecordBatch:
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for row, found in zip(held, repeated_starts([r[5] for r in held], length), strict=True):
            if row[6] == 1:
                first, starts = _runs(found)
                for column, values in zip(columns, (row[2], row[3], row[4] + first, starts), strict=True):
                    column.append(np.broadcast_to(values, len(first)))
        made = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, dtype=np.int64) for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["t1", "t2", "start", "starts"])

    names = ["anchor", "kind", "t1", "t2", "start", "bytes", "copies"]
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if held and row[:2] == held[-1][:2]:
                continue  # the same segment of a repeated row
            if size > SORTED_BYTES and row[0] != held[-1][0]:
                yield result()
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield result()


def _with_bytes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted segments with their bytes, cut from one document of each text."""
    places = wanted.groupBy("t1", "t2").agg(
        F.min("doc_id").alias("_id"), F.collect_list(F.struct("anchor", "kind", "start", "starts", "copies")).alias("list")
    )
    rows = docs.join(places, ["t1", "t2"]).where(F.col("doc_id").eqNullSafe(F.col("_id")))

    def cut(block: pa.RecordBatch) -> dict[str, object]:
        names = ("t1", "t2", "anchor", "kind", "start", "starts", "copies", "bytes")
        out: dict[str, list] = {n: [] for n in names}
        columns = [block.column(n).to_pylist() for n in ("t1", "t2", "text", "list")]
        for t1, t2, text, segs in zip(*columns, strict=True):
            raw = text.encode()
            for s in segs:
                found = {**s, "t1": t1, "t2": t2, "bytes": raw[s["start"] : s["start"] + s["starts"] - 1 + length]}
                for n in names:
                    out[n].append(found[n])
        return out

    schema = "t1 long, t2 long, anchor long, kind long, start long, starts long, copies long, bytes binary"
    return map_blocks(rows.select("t1", "t2", "text", "list"), cut, schema)


def _counted_marks(rows: DataFrame, length: int) -> DataFrame:
    """Marks of segments of crowded anchors: every string by itself, counted by hash."""

    def strings(block: pa.RecordBatch) -> dict[str, object]:
        raw = TextBlock(block.column("bytes"))
        starts = block.column("starts").to_numpy()
        row = np.repeat(np.arange(block.num_rows), starts)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(starts) - starts, starts)
        at, half = raw.offsets[row] + inner, length // 2
        halves = raw.hashes(at, at + half) * U64(0x9E3779B97F4A7C15) + raw.hashes(at + half, at + length)
        take = lambda name: block.column(name).to_numpy()[row]
        return {
            "t1": take("t1"), "t2": take("t2"), "start": take("start") + inner, "copies": take("copies"),
            "w1": raw.hashes(at, at + length).view(np.int64), "w2": mix(halves).view(np.int64),
        }

    schema = "t1 long, t2 long, start long, copies long, w1 long, w2 long"
    found = map_blocks(rows, strings, schema, "bytes").dropDuplicates(["t1", "t2", "start"])
    found = staged(found, "strings")
    again = found.groupBy("w1", "w2").agg(F.sum("copies").alias("n")).where("n > 1").select("w1", "w2")
    once = found.where("copies = 1").join(again, ["w1", "w2"])
    return once.select("t1", "t2", "start", F.lit(1).cast("long").alias("starts"))


def repeats(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, kinds: int = KINDS) -> DataFrame:
    """For each text (`t1`, `t2`: its hash) with any, where strings that start elsewhere too start: a list of runs.

    `keyed` holds doc_id, text, t1 and t2.
    """

    def cut(block: pa.RecordBatch) -> dict[str, object]:
        found = segments(block.column("text"), length, gram)
        own = {n: block.column(n).take(pa.array(found["row"])) for n in ("t1", "t2", "doc_id")}
        return own | {n: found[n] for n in ("anchor", "kind", "start", "starts")}

    schema = "t1 long, t2 long, doc_id long, anchor long, kind long, start long, starts long"
    cuts = staged(map_blocks(keyed, cut, schema), "segments")
    anchors = cuts.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("kind").alias("low"), F.max("kind").alias("high")
    )
    anchors = staged(anchors.where("n > 1").select("anchor", F.expr("low <> high").alias("differ")), "anchors")
    again = staged(cuts.join(anchors, "anchor"), "repeated-anchors")
    counts = staged(again.groupBy("anchor", "kind").agg(F.count(F.lit(1)).alias("copies")), "copies")
    counted = staged(again.join(counts, ["anchor", "kind"]), "kinds")
    whole = counted.where("copies > 1").select("t1", "t2", "start", "starts").distinct()
    wanted = staged(counted.where("differ").dropDuplicates(["anchor", "kind"]), "wanted")
    crowded = staged(wanted.groupBy("anchor").count().where(F.col("count") > kinds).select("anchor"), "crowded")
    held = staged(_with_bytes(keyed, wanted, length), "segment-bytes")
    dealt = held.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor", "kind")
    sorted_marks = dealt.mapInArrow(lambda batches: _sorted_marks(batches, length), MARK)
    marks = whole.unionByName(sorted_marks).unionByName(_counted_marks(held.join(crowded, "anchor"), length))
    runs = marks.groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "starts")).alias("runs"))
    return staged(runs, "runs")


def _spans(runs: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """The maximal spans that runs of starts cover."""
    out: list[list[int]] = []
    for run in sorted(runs or [], key=lambda r: r["start"]):
        start, end = run["start"], run["start"] + run["starts"] - 1 + length
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame, length: int = LENGTH, keep: list[str] | None = None, **options: int) -> DataFrame:
    """The rows with `n_bytes`, `n_removed`, the removed `spans` (first byte, byte after) and the bytes `kept`."""
    text = F.coalesce("text", F.lit(""))
    keys = {"t1": F.xxhash64(text), "t2": F.xxhash64(F.lit(11), text)}
    keyed = docs.drop("runs").withColumns(keys)
    runs = repeats(keyed.select("doc_id", text.alias("text"), "t1", "t2"), length, **options)

    def cut(block: pa.RecordBatch) -> dict[str, object]:
        out: dict[str, list] = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "spans", "kept")}
        for text, found in zip(block.column("text").to_pylist(), block.column("runs").to_pylist(), strict=True):
            raw, done, rest = (text or "").encode(), 0, []
            spans = _spans(found, length)
            for a, b in spans:
                rest.append(raw[done:a])
                done = b
            kept = b"".join([*rest, raw[done:]])
            values = (len(raw), len(raw) - len(kept), len(spans), [{"start": a, "end": b} for a, b in spans], kept)
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        return out

    added = "n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept binary"
    names = [c for c in docs.columns if (keep is None or c in keep) and c not in ("t1", "t2", "runs")]
    return add_columns(keyed.join(runs, ["t1", "t2"], "left"), cut, added, names, uses=("runs",))
