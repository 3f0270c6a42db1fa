"""N-gram Jaccard join: documents whose sets of five-word shingles have a similarity of 0.75 or more.

A text is lower-cased (A-Z), cut at ASCII white space, and stands for its set of distinct shingles of `WORDS` words,
or of its whole sequence if it has fewer. A null or empty text, or one of white space, has no shingles, links with
nothing and is its own component. Documents with equal sets are one class; classes are compared, and links between
classes make the components. Rows with a null doc_id link with nothing and have a null component; doc_ids are taken
to be unique, and rows that share one may be taken for one document. Other columns are not read.

Classes meet in tiles. A tile is a band of set sizes, each a third wider than the last, and the hash of `ROWS`
smallest values of the set under random orders; a class enters `TILES` tiles in its own band and in the next, so
any two sets whose sizes allow the similarity share a band. A tile that classes enter from the band below alone is left
out: they share the tile of their own band too. Two sets of similarity s share no tile with probability
(1 - s**ROWS)**TILES: below 8e-8 at 0.75, below 3e-9 at 0.8. Equal sets do not depend on it. Within a tile,

1. every class meets the tile's smallest class id, and in tiles of `STAR_FROM` classes or more one drawn by hash; pairs
   are verified, and linked classes share a label;
2. in those tiles, every class meets another one drawn by hash, unless they share a label;
3. where a tile still holds several labels, the classes of different labels meet, in blocks.

So the pairs of a large group of copies are never listed: once a group has one label, nothing is left to compare.
The first two steps only save work; the third compares all that they have not joined. There, pairs stay within the task
that compares two blocks, and only links that join labels come out, so near misses cost time but no rows.
A pair is verified by its sizes, then by hashed bitmaps (bits that one set has alone bound the overlap from above),
then by the exact intersection of the sorted hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsieve.llm.common import add_columns, map_blocks, sorted_groups, staged
from barsieve.llm.components import components
from barsieve.llm.textblocks import U64, TextBlock, distinct_in_rows, folded, mix, windows

WORDS = 5
#: Similarity to link, as a fraction.
OVER, UNDER = 75, 100
ROWS, TILES = 3, 30
#: Classes of a tile from which on a meeting with one drawn by hash saves work.
STAR_FROM = 16
#: Classes of a tile that one task compares with as many others, and bytes of their sets.
BLOCK, BLOCK_BYTES = 1024, 32 << 20
MARK = "_text_hash"
#: Bits in a bitmap, at most.
MOST_BITS = 1 << 17


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and the cuts by text."""
    block = TextBlock(texts, lower=True)
    hashes, cuts = windows(block.word_hashes, block.words.bounds, words)
    counts = block.words.counts
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        whole = folded(block.word_hashes, block.words.bounds)[short]
        hashes = np.insert(hashes, cuts[short], whole)
        cuts = cuts + np.concatenate([[0], np.cumsum((counts > 0) & (counts < words))])
    return distinct_in_rows(hashes, cuts)


def _orders() -> np.ndarray:
    return mix(np.arange(1, ROWS * TILES + 1, dtype=U64) * U64(0xC2B2AE3D27D4EB4F)) | U64(1)


def _band(sizes: np.ndarray) -> np.ndarray:
    """Sizes whose ratio allows a link are in one band or in two that follow each other."""
    return np.floor(np.log(np.maximum(sizes, 1)) / np.log(UNDER / OVER) + 1e-9).astype(np.int64)


def tile_keys(hashes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each set that is not empty, its tiles: TILES in its size band, then as many in the next."""
    starts = cuts[:-1][np.diff(cuts) > 0]
    keys = np.zeros((TILES, len(starts)), dtype=U64)
    if not len(starts):
        return keys.T
    for k, order in enumerate(_orders()):
        keys[k // ROWS] = mix(keys[k // ROWS] + np.minimum.reduceat(hashes * order, starts) + U64(k + 1))
    band = _band(np.diff(cuts)[np.diff(cuts) > 0]).astype(U64)
    return np.vstack([mix(keys ^ mix(band + U64(1000) + U64(up))) for up in (0, 1)]).T


def bitmap(hashes: np.ndarray) -> bytes:
    """A power of two of bits, four for each hash or more, with the bits set that the hashes name."""
    bits = min(MOST_BITS, max(64, 1 << int(4 * len(hashes) - 1).bit_length())) if len(hashes) else 64
    flags = np.zeros(bits, dtype=np.uint8)
    flags[hashes & U64(bits - 1)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def _as_words(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=U64)


def overlap_bound(n: int, x: np.ndarray, m: int, y: np.ndarray) -> int:
    """An upper bound of the overlap of sets of n and m hashes with bitmaps x and y; the larger one is folded."""
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))


def linked(overlap: int, n: int, m: int) -> bool:
    return UNDER * overlap >= OVER * (n + m - overlap)


def _mark() -> Column:
    """What tells rows of one doc_id apart that have different texts."""
    return F.xxhash64("text").alias(MARK)


def sketches(docs: DataFrame) -> DataFrame:
    """For each document: a hash of its text, set size, 128 bits that stand for the set, tiles and bitmap."""

    def make(block: pa.RecordBatch) -> dict[str, object]:
        hashes, cuts = shingles(block.column("text"))
        sizes = np.diff(cuts)
        keys = tile_keys(hashes, cuts).view(np.int64)
        ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, 2 * TILES, 0))]).astype(np.int32)
        return {
            "n_shingles": sizes,
            "f1": folded(hashes, cuts).view(np.int64),
            "f2": folded(mix(hashes + U64(77)), cuts).view(np.int64),
            "tiles": pa.ListArray.from_arrays(ends, keys.ravel()),
            "bits": [bitmap(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
        }

    added = "n_shingles long, f1 long, f2 long, tiles array<long>, bits binary"
    return add_columns(docs.select("doc_id", "text", _mark()), make, added, ["doc_id", MARK])


def _within(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """The pairs with columns of both of their classes, as `<column>_a` and `<column>_b`."""
    for end in ("a", "b"):
        side = table.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])
        pairs = pairs.join(side, end)
    return pairs


def _bounded(rows: DataFrame) -> DataFrame:
    """Pairs that their bitmaps allow to link."""

    def run(batches):
        for batch in batches:
            d = batch.to_pydict()
            keep = [
                linked(overlap_bound(n, _as_words(x), m, _as_words(y)), n, m)
                for n, m, x, y in zip(d["n_a"], d["n_b"], d["bits_a"], d["bits_b"], strict=True)
            ]
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(pa.array(keep, type=pa.bool_()))

    return rows.mapInArrow(run, "a long, b long, n_a long, n_b long")


def _exact(rows: DataFrame) -> DataFrame:
    """Pairs whose sorted hashes intersect enough."""

    def run(batches):
        for batch in batches:
            d = batch.to_pydict()
            keep = []
            for x, y in zip(d["hashes_a"], d["hashes_b"], strict=True):
                u, v = _as_words(x), _as_words(y)
                keep.append(linked(len(np.intersect1d(u, v, assume_unique=True)), len(u), len(v)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))

    return rows.mapInArrow(run, "a long, b long")


def _sets(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The sorted hashes of the nodes' texts."""

    def make(block: pa.RecordBatch) -> dict[str, object]:
        hashes, cuts = shingles(block.column("text"))
        found = block.column("doc_id")
        return {"node": found, "hashes": [hashes[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]}

    rows = docs.select("doc_id", "text").join(nodes.withColumnRenamed("node", "doc_id"), "doc_id")
    return staged(map_blocks(rows, make, "node long, hashes binary").dropDuplicates(["node"]), "sets")


class _Verifier:
    """Decides pairs of classes; keeps the hashes of the classes that it has seen, as tables."""

    def __init__(self, classes: DataFrame, docs: DataFrame):
        self.sizes = classes.select("node", F.col("n_shingles").alias("n"), "bits")
        self.docs = docs
        self.sets: DataFrame | None = None

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        """A table of sets (`node`, `hashes`) that has those of these nodes."""
        wanted = nodes.distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("node"), "node", "left_anti")
        fresh = _sets(staged(wanted, "ends"), self.docs)
        self.sets = fresh if self.sets is None else self.sets.unionAll(fresh)
        return self.sets

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (`a`, `b`) that link."""
        sized = _within(pairs, self.sizes, ["n", "bits"])
        sized = sized.where(UNDER * F.least("n_a", "n_b") >= OVER * F.greatest("n_a", "n_b"))
        pairs = staged(_bounded(sized).select("a", "b"), "bounded")
        sets = self.sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        return staged(_exact(_within(pairs, sets, ["hashes"])), "links")


def _joined_so_far(links: DataFrame) -> DataFrame:
    """Labels by which some linked classes, not all, are known to be in one component: `node`, `component`.

    Every class takes the smallest one that it links with, and then that one's.
    """
    ways = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = staged(ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "labels")
    far = near.select(F.col("a").alias("low"), F.col("low").alias("lower"))
    return near.join(far, "low", "left").select(F.col("a").alias("node"), F.coalesce("lower", "low").alias("component"))


def _components_in_tiles(entries: DataFrame, known: DataFrame) -> DataFrame:
    """The tiles' classes with the component that each is in so far."""
    known = known.withColumnRenamed("node", "_n")
    held = entries.join(known, F.col("node") == F.col("_n"), "left")
    return held.select("tile", "node", "n", "m", F.coalesce("component", "node").alias("component"))


def _star_pairs(entries: DataFrame, known: DataFrame | None, turn: int) -> DataFrame:
    """Each tile's classes with one of them, drawn by hash, that is in another component; nothing `known`: is another."""
    alone = entries.select("tile", "node", F.col("node").alias("component"))
    held = alone if known is None else _components_in_tiles(entries, known)
    drawn = F.xxhash64(F.lit(turn), "node")
    leads = held.groupBy("tile").agg(F.min_by("node", drawn).alias("lead"), F.min_by("component", drawn).alias("of"))
    pairs = held.join(leads, "tile").where("component <> of")
    return staged(pairs.select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct(), "star")


def _folded_bits(raw: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of one matrix, folded to the shortest of them."""
    words = [_as_words(b) for b in raw]
    least = min(map(len, words))
    out = np.zeros((len(words), least), dtype=U64)
    for k, w in enumerate(words):
        out[k] = np.bitwise_or.reduce(w.reshape(-1, least), axis=0)
    return out


class _Block:
    """The classes of a tile's two blocks, and which of them may link."""

    def __init__(self, table: pa.Table, tile: int, i: int, j: int):
        column = {c: table.column(c).to_numpy() for c in ("own", "node", "component", "n")}
        self.own, self.node, self.label, self.n = (column[c] for c in ("own", "node", "component", "n"))
        self.label = self.label.copy()
        self.bits = _folded_bits(table.column("bits").to_pylist())
        self.tiles = table.column("tiles").combine_chunks().flatten().to_numpy().reshape(-1, 2 * TILES)
        self.tile, self.i, self.j = tile, i, j

    def partners(self, k: int) -> np.ndarray:
        """Classes of other labels that sizes and bitmaps allow to link with class k.

        A pair counts in the smallest tile that both are in and one of them by its own band; they have different labels
        in every tile they share.
        """
        n = self.n
        near = (self.label != self.label[k]) & (self.own == self.j)
        near &= (self.node > self.node[k]) if self.i == self.j else True
        near &= UNDER * np.minimum(n[k], n) >= OVER * np.maximum(n[k], n)
        at = np.flatnonzero(near)
        if not len(at):
            return at
        alone = np.bitwise_count(self.bits[k] & ~self.bits[at]).sum(axis=1, dtype=np.int64)
        others = np.bitwise_count(self.bits[at] & ~self.bits[k]).sum(axis=1, dtype=np.int64)
        most = np.minimum(n[k] - alone, n[at] - others)
        at = at[UNDER * most >= OVER * (n[k] + n[at] - most)]
        shared, mine = self.tiles[at], self.tiles[k]
        top = np.iinfo(np.int64).max
        meet = np.hstack([np.isin(shared[:, :TILES], mine), np.isin(shared[:, TILES:], mine[:TILES])])
        first = np.where(meet, shared, top).min(axis=1, initial=top)
        return at[first == self.tile]

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        for k in np.flatnonzero(self.own == self.i):
            yield k, self.partners(k)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, _Block]]:
    """Blocks of several labels, from rows sorted by tile and blocks."""
    for table, cuts in sorted_groups(batches, ["tile", "i", "j"]):
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            part = table.slice(start, end - start)
            if pc.count_distinct(part.column("component")).as_py() > 1:
                yield part, _Block(part, *[part.column(c)[0].as_py() for c in ("tile", "i", "j")])


def _with_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of each block that may link with another one there: a row for each of them, not for each pair."""
    for part, block in _blocks(batches):
        found = np.zeros(part.num_rows, dtype=bool)
        for k, at in block:
            found[k] |= len(at) > 0
            found[at] = True
        if found.any():
            yield from part.select(["tile", "i", "j", "own", "node", "component"]).filter(pa.array(found)).to_batches()


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each block that join its labels, a spanning forest; what they join is not compared again."""
    for part, block in _blocks(batches):
        sets = [_as_words(h) for h in part.column("hashes").to_pylist()]
        found = []
        for k, at in block:
            for m in at:
                if block.label[m] != block.label[k]:
                    u, v = sets[k], sets[m]
                    if linked(len(np.intersect1d(u, v, assume_unique=True)), len(u), len(v)):
                        found.append((block.node[k], block.node[m]))
                        block.label[block.label == block.label[m]] = block.label[k]
        if found:
            ends = np.array(found)
            yield pa.RecordBatch.from_pydict({"a": ends.min(axis=1), "b": ends.max(axis=1)})


def _across(entries: DataFrame, classes: DataFrame, known: DataFrame, verifier: _Verifier) -> DataFrame:
    """Links that join the classes which share a tile but not a component.

    Pairs stay within the task that compares two blocks: it first tells which classes have partners that bitmaps allow,
    and when those have come with their sets, which of them link.
    """
    held = _components_in_tiles(entries, known)
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("hashes") * 8 / BLOCK_BYTES)).cast("int")
    mixed = (
        held.groupBy("tile")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.sum("n").alias("hashes"), F.max("m").alias("m"))
        .where("lo <> hi and m > 2")
        .select("tile", blocks.alias("blocks"))
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = held.join(mixed, "tile").withColumn("own", own)
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j")),
    )
    rows = rows.select("tile", "node", "component", "own", F.explode(meets).alias("at"))
    rows = rows.select("tile", "at.i", "at.j", "own", "node", "component")
    order = ["tile", "i", "j"]
    wide = classes.select("node", F.col("n_shingles").alias("n"), "bits", "tiles")
    dealt = rows.join(wide, "node").repartition(*order).sortWithinPartitions(*order)
    kept = "tile long, i int, j int, own int, node long, component long"
    near = staged(dealt.mapInArrow(_with_partners, kept), "partners")
    whole = near.join(wide, "node").join(verifier.sets_of(near.select("node")), "node")
    dealt = whole.repartition(*order).sortWithinPartitions(*order)
    return staged(dealt.mapInArrow(_block_links, "a long, b long").distinct(), "across")


def near_copies(docs: DataFrame) -> DataFrame:
    """For each row of `docs` (doc_id, text): `doc_id`, `n_shingles`, `component_id`."""
    return _marked_copies(docs).drop(MARK)


def _marked_copies(docs: DataFrame) -> DataFrame:
    found = staged(sketches(docs), "sketches")
    usable = found.where("n_shingles > 0 and doc_id is not null")
    # One row for each class: its tiles and bitmap are the same in all of its documents.
    heads = usable.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("node"))
    heads = staged(heads, "classes")
    own = usable.select(F.col("doc_id").alias("node"), "f1", "f2", "tiles", "bits").dropDuplicates(["node", "f1", "f2"])
    classes = staged(own.join(heads, ["node", "f1", "f2"]).select("node", "n_shingles", "tiles", "bits"), "class-sketches")
    entries = classes.select("node", F.col("n_shingles").alias("n"), F.posexplode("tiles").alias("at", "tile"))
    shared = entries.groupBy("tile").agg(
        F.min("node").alias("lead"), F.count(F.lit(1)).alias("m"), F.min("at").alias("at")
    )
    shared = shared.where((F.col("m") > 1) & (F.col("at") < TILES)).drop("at")
    entries = staged(entries.join(shared, "tile").select("tile", "lead", "node", "n", "m"), "tiles")
    large = entries.where(F.col("m") >= STAR_FROM)
    pairs = entries.where("lead <> node").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    pairs = staged(pairs.unionAll(_star_pairs(large, None, 0)).distinct(), "pairs")
    verifier = _Verifier(classes, docs)
    links = verifier.links(pairs)
    known = staged(_joined_so_far(links), "joined")
    star = _star_pairs(large, known, 1).join(pairs, ["a", "b"], "left_anti")
    links = links.unionAll(verifier.links(star))
    known = staged(_joined_so_far(links), "joined")
    joined = components(links.unionAll(_across(entries, classes, known, verifier)))
    nodes = heads.join(joined, "node", "left").select(
        "f1", "f2", "n_shingles", F.coalesce("component", "node").alias("component")
    )
    counted = found.select("doc_id", MARK, "n_shingles", "f1", "f2")
    return counted.join(nodes, ["f1", "f2", "n_shingles"], "left").select(
        "doc_id",
        MARK,
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id; rows without shingles or doc_id stay.

    Of rows that are equal in doc_id and text, and have shingles, one stays. Rows that share a doc_id alone are told
    apart: one that is a copy of a smaller doc_id goes without the others.
    """
    row = ["doc_id", MARK]
    found = staged(_marked_copies(docs), "near-copies").where("doc_id is not null")
    is_copy = F.expr("n_shingles > 0 and component_id <> doc_id")
    by_id = found.groupBy("doc_id").agg(
        F.min(MARK).alias("lo"), F.max(MARK).alias("hi"), F.max(is_copy).alias("copy"), F.count(F.lit(1)).alias("rows")
    )
    by_id = staged(by_id.where("copy or rows > 1"), "copies")
    # an id that has one text goes by itself; rows of the others are told apart by their texts
    copies = by_id.where("copy and lo = hi").select("doc_id")
    several = found.join(by_id.where("rows > 1").select("doc_id"), "doc_id").groupBy(row)
    several = several.agg(F.max(is_copy).alias("copy"), F.max("n_shingles").alias("n"), F.count(F.lit(1)).alias("rows"))
    several = staged(several, "several")
    repeated = several.where("not copy and n > 0 and rows > 1").select(row)
    marked = docs.withColumn(MARK, _mark())
    rest = marked.join(copies, "doc_id", "left_anti")
    rest = rest.join(several.where("copy or (n > 0 and rows > 1)").select(row), row, "left_anti")
    return rest.unionByName(marked.join(repeated, row).dropDuplicates(row)).select(docs.columns)
