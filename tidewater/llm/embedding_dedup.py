"""Near duplicates among embeddings: Euclidean p-stable hashing and exact cosine checks.

Normalised vectors are projected on Gaussian directions, shifted and cut into cells of width
``WIDTH``. ``HASHES`` cells make a bucket, and every one of ``TABLES`` tables has its own. Vectors of a cosine of 0.93
are 0.374 apart and share a cell with probability 0.85, so a bucket with 0.28 and one of the 16 tables with 0.994.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.components import components
from tidewater.llm.shared import mix64, only, rows_of
from tidewater.session import settle

LEAST = 0.93
TABLES, HASHES, WIDTH = 16, 8, 2.0
#: Vectors of a bucket that meet in one task; larger buckets are dealt into blocks that meet pair by pair.
BLOCK = 2_048
SEED = 7


@lru_cache(maxsize=8)
def _directions(dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and shifts of all tables, the same in every task."""
    draw = np.random.Generator(np.random.PCG64([SEED, dims]))
    return draw.standard_normal((dims, TABLES * HASHES)), draw.uniform(0, WIDTH, TABLES * HASHES)


def buckets(unit: np.ndarray) -> np.ndarray:
    """64-bit bucket of every vector (rows) in every table (columns)."""
    along, shift = _directions(unit.shape[1])
    cells = np.floor((unit @ along + shift) / WIDTH).astype(np.int64).view(np.uint64)
    cells = cells.reshape(len(unit), TABLES, HASHES)
    key = np.tile(np.arange(TABLES, dtype=np.uint64), (len(unit), 1))
    for k in range(HASHES):
        key = mix64(key + cells[:, :, k])
    return key.view(np.int64)


_HASHED = "dims int, label long, bucket long, turn int, node long, copies long, vector binary, keys binary"


def _hashed(with_vectors: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 500):
            by_dims: dict[int, list[int]] = {}
            vectors = batch["embedding"].to_pylist()
            for k, v in enumerate(vectors):
                by_dims.setdefault(len(v), []).append(k)
            node, label, copies = (batch[c].to_numpy() for c in ("node", "label", "copies"))
            for dims, at in by_dims.items():
                x = np.array([vectors[k] for k in at], np.float64)
                scale = np.abs(x).max(axis=1, keepdims=True)  # first, so that squares neither vanish nor overflow
                unit = x / scale
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                key = buckets(unit)
                raw, keys = ([v.tobytes() for v in x] if with_vectors else [b""] * len(at) for x in (unit, key))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(key.size, dims, np.int32)), pa.array(np.repeat(label[at], TABLES)),
                     pa.array(key.ravel()), pa.array(np.tile(np.arange(TABLES, dtype=np.int32), len(at))),
                     pa.array(np.repeat(node[at], TABLES)), pa.array(np.repeat(copies[at], TABLES)),
                     *(pa.array([r for r in x for _ in range(TABLES)], pa.binary()) for x in (raw, keys))],
                    names=["dims", "label", "bucket", "turn", "node", "copies", "vector", "keys"],
                )

    return run


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots, each the smallest of its class, after the links ``a, b``."""
    while (apart := root[a] != root[b]).any():
        low, high = np.minimum(root[a], root[b])[apart], np.maximum(root[a], root[b])[apart]
        np.minimum.at(root, high, low)
        while not np.array_equal(up := root[root], root):
            root = up
    return root


def _checked(least: float):
    """For each node linked within a run of rows of one (bucket, pair of blocks), to which node its links lead there and
    how many vectors it links to. Rows come sorted by the bucket.

    A pair counts in the first table that has both in one bucket, so once in all. No pair is ever a row: a run gives as
    many rows as it has linked nodes.
    """

    def links(rows: list[tuple], turn: int):
        if len(rows) < 2:
            return
        node, copies, block, raw, keys = zip(*rows)
        node, copies, block = np.array(node), np.array(copies), np.array(block)
        x = np.stack([np.frombuffer(r, np.float64) for r in raw])
        keys = np.stack([np.frombuffer(r, np.int64) for r in keys])[:, :turn]
        # A pair of blocks checks what lies between them, a block with itself what lies inside.
        one = np.flatnonzero(block == block.min())
        other = one if block.min() == block.max() else np.flatnonzero(block == block.max())
        root, others = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        for at in range(0, len(one), 64):
            rows_at = one[at : at + 64]
            a, b = np.nonzero(x[rows_at] @ x[other].T >= least)
            a, b = rows_at[a], other[b]
            if other is one:
                a, b = a[node[a] < node[b]], b[node[a] < node[b]]
            first = ~(keys[a] == keys[b]).any(axis=1)
            a, b = a[first], b[first]
            np.add.at(others, a, copies[b])
            np.add.at(others, b, copies[a])
            root = joined(root, a, b)
        some = np.flatnonzero(others)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (node[some], node[root[some]], others[some])], names=["u", "v", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, now = None, [], 0
        names = ("dims", "label", "bucket", "low", "high", "turn", "node", "copies", "block", "vector", "keys")
        for batch in rows_of(batches):
            for *key, turn, node, copies, block, vector, keys in zip(*(batch[c].to_pylist() for c in names)):
                if (*key, turn) != group:
                    yield from links(rows, now)
                    group, rows, now = (*key, turn), [], turn
                rows.append((node, copies, block, vector, keys))
        yield from links(rows, now)

    return run


def near_embeddings(vectors: DataFrame, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors with one label whose cosine is at least ``least`` are linked where some table
    has them in one bucket; none below it ever is. Exact copies become one node with a
    count, so a vector that fills a third of the table is hashed once; large buckets are
    dealt into blocks and every pair of blocks is checked in full. Links are counted and joined to classes
    where they are found, so what is written is linear in the vectors.

    Cases: null vectors, those without length, with a null or non-finite component, and those with
    a null label link with nothing; vectors of different lengths are never compared; repeated
    rows are vectors of their own; a null id takes part, and its component is named by the smallest
    id that is not null, or by null; an empty table gives no rows.
    """
    rows = only(vectors, vec_id="long", embedding="array<double>", label="long")
    fit = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    some = F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(fit & some & F.col("label").isNotNull(), F.lit(False))
    keyed = rows.select(
        "vec_id", F.when(usable, F.xxhash64("label", "embedding")).alias("k1"),
        F.when(usable, F.xxhash64(F.lit(1), "label", "embedding")).alias("k2"), "label", "embedding",
    )
    ids = settle(keyed.select("vec_id", "k1", "k2"), "ids")
    nodes = keyed.where("k1 is not null").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("embedding").alias("embedding"),
    )
    # A node without any id is named by its key.
    nodes = settle(nodes.withColumn("node", F.coalesce("least", "k1")), "nodes")
    source = nodes.select("node", "copies", "label", "embedding")
    counts = source.mapInArrow(_hashed(False), _HASHED).groupBy("dims", "label", "bucket").agg(F.count("*").alias("n"))
    large = settle(counts.where(F.col("n") > block), "large")
    large = large.select(
        F.col("dims").alias("d"), F.col("label").alias("l"), F.col("bucket").alias("b"),
        F.ceil(F.col("n") / block).cast("int").alias("blocks"),
    )
    hashed = source.mapInArrow(_hashed(True), _HASHED)
    hashed = hashed.join(large, (F.col("dims") == F.col("d")) & (F.col("label") == F.col("l")) & (F.col("bucket") == F.col("b")), "left")
    hashed = hashed.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    hashed = hashed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    hashed = hashed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    hashed = hashed.select(
        "dims", "label", "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "turn", "node", "copies", "block", "vector", "keys",
    )
    group = ["dims", "label", "bucket", "low", "high", "turn"]
    links = hashed.repartition(*group[:5]).sortWithinPartitions(*group).mapInArrow(_checked(least), "u long, v long, n long")
    links = settle(links, "links")
    ends = links.groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("others"))
    classes = components(links.select("u", "v"), "near-vectors")
    nodes = nodes.drop("embedding", "label").join(ends, "node", "left").join(classes, "node", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "node"))
    names = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(names, "component").select(
        "k1", "k2", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    out = ids.join(nodes, ["k1", "k2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
