"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations, with several probes a table.

A vector is rotated by three rounds of random signs and a Hadamard transform; its hash is the axis it is nearest to,
with the sign. A bucket is `k` such hashes, and a vector goes to the bucket of its nearest axes and to those in which
one axis is replaced by the runner-up. `k` follows the number of vectors so that a bucket holds a few tens of
unrelated ones at any size, and the number of tables follows `k`. Vectors that share a bucket are compared by cosine
in double precision, and only pairs of `THRESHOLD` or more link.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; so do vectors of
different lengths with each other. Equal vectors are one class and are never compared with each other; each of their
rows counts as a link of all the others. Rows without vec_id link with nothing. vec_ids are taken to be unique.

No pair leaves its bucket: a bucket gives, for each of its vectors, the number of links first found there (a pair is
counted in the first bucket that both share), and a spanning forest. A bucket of more than `BLOCK` vectors is compared
in pairs of blocks, by different tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from barsieve.llm.common import sorted_groups, staged
from barsieve.llm.components import components

THRESHOLD = 0.9
#: Vectors that a bucket is to hold, about; vectors of one block of a bucket.
BUCKET, BLOCK = 64, 1024
SEED = 90


def tables_for(k: int) -> int:
    """Tables that find a pair at the threshold with a probability of about 0.995.

    By simulation, two vectors of 64 components with a cosine of 0.9 share a bucket in one table with a probability
    of 0.82 (k = 1), 0.62 (2) or 0.42 (3).
    """
    return math.ceil(math.log(0.005) / math.log(1 - 0.82 * 0.72 ** (k - 1)))


def hashes_for(vectors: int, axes: int) -> int:
    """Hashes a bucket, so that unrelated vectors fill a bucket to about BUCKET."""
    return max(1, math.ceil(math.log(max(1, vectors / BUCKET)) / math.log(2 * axes)))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, scaled to keep lengths; rows are a power of two long."""
    n, step = x.shape[1], 1
    while step < n:
        y = x.reshape(len(x), -1, 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / math.sqrt(n)


def nearest_axes(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """For each vector, table and hash, the nearest axis after the rotation and the runner-up, signs included."""
    axes = 1 << max(1, math.ceil(math.log2(max(2, unit.shape[1]))))
    padded = np.zeros((len(unit), axes))
    padded[:, : unit.shape[1]] = unit
    signs = np.random.default_rng(SEED).choice([-1.0, 1.0], size=(tables, k, 3, axes))
    out = np.zeros((len(unit), tables, k, 2), dtype=np.uint32)
    rows = np.arange(len(unit))
    for t in range(tables):
        for h in range(k):
            x = padded
            for flips in signs[t, h]:
                x = hadamard(x * flips)
            size = np.abs(x)
            order = np.argpartition(-size, 1, axis=1)[:, :2]
            swap = size[rows, order[:, 0]] < size[rows, order[:, 1]]
            order[swap] = order[swap][:, ::-1]
            out[:, t, h] = 2 * order + (x[rows[:, None], order] < 0)
    return out


def bucket_codes(axes: np.ndarray, most: int) -> np.ndarray:
    """For each vector and table, `k + 1` buckets: that of the nearest axes, then one axis at a time replaced."""
    vectors, tables, k, _ = axes.shape
    out = np.zeros((vectors, tables, k + 1), dtype=np.int64)
    for probe in range(k + 1):
        for h in range(k):
            out[:, :, probe] = out[:, :, probe] * most + axes[:, :, h, int(probe == h + 1)]
    return out * tables + np.arange(tables)[None, :, None]


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe from overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _entries(batches: Iterator[pa.RecordBatch], k: int, tables: int, most: int) -> Iterator[pa.RecordBatch]:
    """A row for each vector and bucket: `length`, `bucket`, `node`, `copies`, `vector`, `axes`."""
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            lists = batch.column("vector")
            flat, sizes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), lists.value_lengths().to_numpy()
            ends = np.cumsum(sizes)
            for length in np.unique(sizes):
                at = np.flatnonzero(sizes == length)
                x = flat[(ends[at] - length)[:, None] + np.arange(length)]
                axes = nearest_axes(_unit(x), k, tables)
                codes, per = bucket_codes(axes, most), tables * (k + 1)
                exact = x.astype(np.float32) if (x.astype(np.float32) == x).all() else x
                raw, own = [row.tobytes() for row in exact], [row.tobytes() for row in axes.astype(np.uint32)]
                rows = np.repeat(np.arange(len(at)), per)
                picked = batch.take(pa.array(at[rows]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "length": pa.array(np.full(len(rows), length), pa.int32()),
                        "bucket": pa.array(codes.reshape(-1), pa.int64()),
                        "node": picked.column("node"),
                        "copies": picked.column("copies"),
                        "vector": pa.array(raw, pa.binary()).take(pa.array(rows)),
                        "axes": pa.array(own, pa.binary()).take(pa.array(rows)),
                    }
                )


def _vector(raw: bytes, length: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.float32 if len(raw) == 4 * length else np.float64).astype(np.float64)


def _forest(near: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """For a symmetric link matrix, the smallest node of each one's component."""
    label = nodes.copy()
    top = np.iinfo(np.int64).max
    while True:
        lower = np.minimum(label, np.where(near, label[None, :], top).min(axis=1))
        if (lower == label).all():
            return label
        label = lower


def _links(
    nodes: np.ndarray, x: np.ndarray, codes: np.ndarray, own: np.ndarray, bucket: int, tables: int, i: int, j: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one bucket, or two blocks of it: pairs to count (positions) and, for each vector, its root."""
    cosine = x @ x.T
    near = cosine >= THRESHOLD
    np.fill_diagonal(near, False)
    if i != j:
        near &= own[:, None] != own[None, :]
    a, b = np.nonzero(np.triu(near))
    probes = codes.shape[1] // tables
    table = bucket % tables
    for t in range(table + 1):
        part = codes[:, t * probes : (t + 1) * probes]
        if not len(a):
            break
        earlier = np.zeros(len(a), dtype=bool)
        for p in range(probes):
            for q in range(probes):
                same = part[a, p] == part[b, q]
                earlier |= same if t < table else same & (part[a, p] < bucket)
        a, b = a[~earlier], b[~earlier]
    return a, b, near.any(axis=1), _forest(near, nodes)


def _compared(batches: Iterator[pa.RecordBatch], k: int, tables: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and blocks to `node`, `links` first found here and `root` in the bucket."""
    for table, cuts in sorted_groups(batches, ["length", "bucket", "i", "j"]):
        column = {c: table.column(c).to_numpy() for c in ("length", "bucket", "i", "j", "own", "node", "copies")}
        vectors, packed = table.column("vector").to_pylist(), table.column("axes").to_pylist()
        node_out, link_out, root_out = [], [], []
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if end - start < 2:
                continue
            length, bucket, i, j = (int(column[c][start]) for c in ("length", "bucket", "i", "j"))
            nodes, copies, own = (column[c][start:end] for c in ("node", "copies", "own"))
            x = _unit(np.array([_vector(raw, length) for raw in vectors[start:end]]))
            axes = np.frombuffer(b"".join(packed[start:end]), dtype=np.uint32).reshape(len(nodes), tables, k, 2)
            codes = bucket_codes(axes, most).reshape(len(nodes), -1)
            a, b, touched, root = _links(nodes, x, codes, own, bucket, tables, i, j)
            links = np.bincount(a, copies[b], len(nodes)) + np.bincount(b, copies[a], len(nodes))
            node_out.append(nodes[touched])
            link_out.append(links[touched].astype(np.int64))
            root_out.append(root[touched])
        if node_out:
            out = {"node": np.concatenate(node_out), "links": np.concatenate(link_out), "root": np.concatenate(root_out)}
            yield pa.RecordBatch.from_pydict(out)


def near_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """For each row: `vec_id`, `n_links`, `component_id`, `kept` (vec_id is the smallest of its component)."""
    value = F.col(column).cast(ArrayType(DoubleType()))
    big = F.lit(float("inf"))
    sound = F.col("vec_id").isNotNull() & F.coalesce(
        F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < big)) & F.exists(value, lambda v: v != 0),
        F.lit(False),
    )
    keyed = vectors.select("vec_id", value.alias("vector"), sound.alias("sound"))
    keyed = keyed.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(5), "vector")})
    usable = keyed.where("sound")
    classes = usable.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    classes = staged(classes, "vector-classes")
    heads = usable.select(F.col("vec_id").alias("node"), "h1", "h2", "vector").join(classes, ["node", "h1", "h2"])
    heads = staged(heads.dropDuplicates(["node"]).select("node", "copies", "vector"), "vectors")
    shape = heads.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("length")).first()
    axes = 1 << max(1, math.ceil(math.log2(max(2, shape["length"] or 2))))
    k = hashes_for(shape["n"], axes)
    tables = tables_for(k)
    entry = "length int, bucket long, node long, copies long, vector binary, axes binary"
    entries = heads.mapInArrow(lambda batches: _entries(batches, k, tables, 2 * axes), entry)
    large = entries.groupBy("length", "bucket").count().where(F.col("count") > BLOCK)
    large = large.select("length", "bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    large = staged(large, "large-buckets")
    blocks = F.coalesce("blocks", F.lit(1))
    rows = entries.join(large, ["length", "bucket"], "left").withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    meets = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda m: F.struct(F.least(m, F.col("own")).alias("i"), F.greatest(m, F.col("own")).alias("j")),
    )
    rows = rows.withColumn("at", F.explode(meets)).select("length", "bucket", "at.i", "at.j", "own", "node", "copies", "vector", "axes")
    order = ["length", "bucket", "i", "j"]
    dealt = rows.repartition(*order).sortWithinPartitions(*order)
    found = dealt.mapInArrow(lambda batches: _compared(batches, k, tables, 2 * axes), "node long, links long, root long")
    found = staged(found, "vector-links")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_class = (
        classes.join(counted, "node", "left")
        .join(linked, "node", "left")
        .select(
            "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    joined = keyed.select("vec_id", "h1", "h2", "sound").join(per_class, ["h1", "h2"], "left")
    component = F.when(F.col("sound"), F.col("component")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.when(F.col("sound"), F.col("n")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )

