"""Operator 1: near-duplicate embeddings by Euclidean p-stable hashing and exact cosine checks.

Vectors are normalised, so a cosine of ``threshold`` is a Euclidean distance. Each of several
tables quantises ``k`` Gaussian projections, shifted at random, into one bucket code. The numbers
follow the textbook rule from the number n of distinct vectors: k so large that unrelated vectors
(right angles) share a bucket ``1 / 8`` of a time per vector, and as many tables as leave a pair at
exactly the threshold undetected with a chance of at most ``miss``.

Equal vectors are one node, with the number of its copies. Nodes within half the threshold's angle
of one center are linked with each other for certain, so a large group of near copies is counted
and not compared. Within a bucket, members of different centers are compared in double precision;
the pairs themselves never leave the task: a bucket returns for each member its number of new links
and its root in the bucket. A link found in several tables counts in the first where the two share
a bucket. Buckets are dealt into blocks of ``block`` members, and each pair of blocks is compared
by itself; members of a bucket's largest center meet the others only, so a bucket that is nearly
one center costs about a row a member.

Defined cases: vectors that are null, zero, empty or hold null or non-finite components link with
nothing; vectors of another length than most are compared only among their own length; rows whose
id is null link with nothing; an id may be repeated: every row counts, with the vector that it has, and
equal vectors are copies whatever their ids. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import _bytes
from tidemark.llm._groups import dealt, sorted_groups
from tidemark.llm._tables import materialise
from tidemark.llm.components import components


def collision(distance: float, width: float) -> float:
    """Chance that one quantised projection puts two points at that distance together."""
    x = width / distance
    inside = math.erf(x / math.sqrt(2))
    return inside - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def index_size(n: int, threshold: float, width: float, miss: float) -> tuple[int, int]:
    """Projections of a table, and tables."""
    near, far = collision(math.sqrt(2 - 2 * threshold), width), collision(math.sqrt(2), width)
    k = max(4, math.ceil(math.log(8 * max(n, 2)) / -math.log(far)))
    return k, math.ceil(math.log(miss) / math.log1p(-(near**k)))


class Tables:
    """The random projections. A vector's codes don't depend on the vectors beside it."""

    def __init__(self, size: int, k: int, many: int, width: float, seed: int):
        random = np.random.default_rng([seed, size])
        self.a = random.standard_normal((many, k, size))
        self.b = random.random((many, k)) * width
        self.k, self.many, self.width = k, many, width

    def codes(self, unit: np.ndarray, upto: int | None = None) -> np.ndarray:
        """Bucket code of each vector in the first ``upto`` tables."""
        many = self.many if upto is None else upto
        out = np.empty((len(unit), many), dtype=np.uint64)
        step = max(1, (1 << 19) // max(1, self.k * unit.shape[1]))
        for t in range(many):
            for i in range(0, len(unit), step):
                at = (unit[i : i + step, None, :] * self.a[t]).sum(axis=-1)  # one sum a row: the same whatever the batch
                cell = np.floor((at + self.b[t]) / self.width).astype(np.int64).astype(np.uint64)
                code = np.full(len(cell), t + 1, dtype=np.uint64)
                for j in range(self.k):
                    code = _bytes.mix64(code * np.uint64(0x9E3779B97F4A7C15) + cell[:, j])
                out[i : i + step, t] = code
        return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by length: their indices and their vectors."""
    sizes = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    at = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[at[rows][:, None] + np.arange(size)]


def _coded(k: int, many: int, width: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, Tables] = {}
        for batch in batches:
            for rows, vectors in _matrices(batch.column("v")):
                size = vectors.shape[1]
                own = tables.setdefault(size, Tables(size, k, many, width, seed))
                codes = own.codes(_unit(vectors)) ^ np.uint64(size)
                nodes = batch.column("node").to_numpy()[rows]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(nodes, many)), pa.array(np.tile(np.arange(many, dtype=np.int32), len(rows))), pa.array(codes.ravel().view(np.int64))], names=["node", "t", "code"])

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each member's component, for links between members 0 to n - 1."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compared(k: int, many: int, width: float, seed: int, threshold: float):
    """Over rows sorted by bucket and pair of blocks: each member's new links and root."""
    tables: dict[int, Tables] = {}

    def group(t: int, same_block: bool, node: np.ndarray, center: np.ndarray, side: np.ndarray, copies: np.ndarray, vectors: np.ndarray):
        unit = _unit(vectors)
        centers, sizes = np.unique(center, return_counts=True)
        turn = np.flatnonzero(center != centers[sizes.argmax()])  # members of the largest cluster need no turn of their own
        place = np.full(len(node), len(node))
        place[turn] = np.arange(len(turn))
        near = (unit[turn] @ unit.T >= threshold) & (center[turn][:, None] != center) & (place > np.arange(len(turn))[:, None])
        if not same_block:
            near &= side[turn][:, None] != side
        a, b = np.nonzero(near)
        a = turn[a]
        if t and len(a):
            used = np.unique(np.concatenate((a, b)))
            size = vectors.shape[1]
            codes = tables.setdefault(size, Tables(size, k, many, width, seed)).codes(unit[used], t)
            row = np.zeros(len(node), dtype=np.int64)
            row[used] = np.arange(len(used))
            fresh = np.ones(len(a), dtype=bool)
            for i in range(0, len(a), 1 << 14):
                part = slice(i, i + (1 << 14))
                fresh[part] = ~(codes[row[a[part]]] == codes[row[b[part]]]).any(axis=1)
            a, b = a[fresh], b[fresh]
        if not len(a):
            return None
        links = np.bincount(a, copies[b], minlength=len(node)) + np.bincount(b, copies[a], minlength=len(node))
        linked = links > 0
        return node[linked], links[linked].astype(np.int64), node[_roots(len(node), a, b)][linked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_groups(batches, ["t", "code", "low", "high"]):
            if len(rows) < 2:
                continue
            node, center, side, copies = (rows[c].to_numpy() for c in ("node", "center", "side", "copies"))
            if (center == center[0]).all():
                continue
            vectors = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
            found = group(rows["t"][0].as_py(), rows["low"][0].as_py() == rows["high"][0].as_py(), node, center, side, copies, vectors)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["node", "links", "root"])

    return run


def _close(least: float):
    """Of (node, head, v, w), those whose vectors have at least that cosine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            w = batch.column("w")
            for rows, vectors in _matrices(batch.column("v")):
                same = rows[np.asarray(w.value_lengths())[rows] == vectors.shape[1]]
                if len(same):
                    other = np.stack([np.asarray(x, dtype=np.float64) for x in w.take(pa.array(same)).to_pylist()])
                    keep[same] = (_unit(vectors[np.isin(rows, same)]) * _unit(other)).sum(axis=1) >= least
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("node", "head")], names=["node", "head"])

    return run


def clusters(nodes: DataFrame, coded: DataFrame, threshold: float, first_tables: int) -> DataFrame:
    """(node, center) for nodes close to the least member of one of their first buckets.

    Close means within half the angle of the threshold: by the triangle inequality all nodes of
    one center are then linked with each other, and none of those pairs needs a look.
    """
    half = math.cos(math.acos(threshold) / 2 - 1e-9)
    own = coded.filter(F.col("t") < first_tables)
    heads = own.groupBy("t", "code").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    star = own.join(heads, ["t", "code"]).filter("node <> head").select("node", "head").distinct()
    pairs = star.join(nodes.select("node", "v"), "node").join(nodes.select(F.col("node").alias("head"), F.col("v").alias("w")), "head")
    close = pairs.select("node", "head", "v", "w").mapInArrow(_close(half), "node long, head long")
    return close.groupBy("node").agg(F.min("head").alias("center"))


def _nodes(rows: DataFrame) -> DataFrame:
    """A row for each distinct vector: v, the least id of its rows, their number, and node, a hash of
    the vector that no other one has."""
    nodes = rows.groupBy("v").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    for salt in itertools.count():
        nodes = materialise(nodes.withColumn("node", F.xxhash64(F.lit(salt), "v")), "vectors")
        if nodes.groupBy("node").count().filter("count > 1").isEmpty():
            return nodes


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9, width: float = 2.0, miss: float = 0.03, block: int = 2048, first_tables: int = 16, seed: int = 7) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = df.select(df[key].cast("long").alias("vec_id"), df[vector].alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    sound = F.coalesce(sound, F.lit(False))
    nodes = _nodes(rows.filter(sound))
    k, many = index_size(nodes.count(), threshold, width, miss)
    coded = materialise(nodes.select("node", "v").mapInArrow(_coded(k, many, width, seed), "node long, t int, code long"), "vector-codes")
    centers = materialise(clusters(nodes, coded, threshold, min(first_tables, many)), "vector-clusters")
    placed = nodes.join(centers, "node", "left").withColumn("center", F.coalesce("center", "node"))
    marked = coded.join(placed.select("node", "center"), "node")
    buckets = marked.groupBy("t", "code").agg(F.min("center").alias("lo"), F.max("center").alias("hi")).filter("lo < hi").select("t", "code")
    open_ = materialise(marked.join(buckets, ["t", "code"]), "vector-buckets")
    members = dealt(open_, ["t", "code"], "center", "node", block).drop("center").join(placed, "node")
    by = ["t", "code", "low", "high"]
    found = members.select(*by, "node", "center", "side", "copies", "v").repartition(*by).sortWithinPartitions(*by)
    linked = materialise(found.mapInArrow(_compared(k, many, width, seed, threshold), "node long, links long, root long"), "vector-links")
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    sizes = placed.groupBy("center").agg(F.sum("copies").alias("together"))
    stars = centers.select(F.col("node").alias("a"), F.col("center").alias("b"))
    roots = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")).union(stars))
    known = placed.join(sizes, "center").join(counts, "node", "left").join(roots, "node", "left").select(F.col("v").alias("its"), "first", "together", "links", F.coalesce("root", "node").alias("root"))
    known = materialise(known, "vectors-known")
    known = known.join(known.groupBy("root").agg(F.min("first").alias("component_id")), "root")
    # equal vectors find their node by value; unsound ones have none
    joined = rows.filter(sound).join(known, F.col("v") == F.col("its"))
    of_sound = joined.select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("together") - 1).cast("long").alias("n_links"), "component_id")
    of_rest = rows.filter(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return of_sound.union(of_rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
