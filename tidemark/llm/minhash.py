"""Operator 6: near-duplicate documents by improved consistent weighted sampling.

A document is the weighted set of its five-word shingles; a shingle weighs its count in the
document times its inverse document frequency. Document frequencies are exact, over all documents,
by the block exchange. The inverse frequency is damped: ``floor + (1 - floor) * ln(N / df) / ln N``.
Undamped, the many copies of a large near-copy group would make the shared text weigh next to
nothing against each copy's own few changes, and tear the group apart.

Improved consistent weighted sampling draws ``bands * rows`` samples from each set; sets that agree
on all rows of a band are candidates, and are linked if their weighted Jaccard similarity, from the
full weighted sets, is at least ``threshold``.

A bucket of a band is never expanded into all its pairs: first every member is compared with the
bucket's least member. Most buckets are one component after that. In the others, members of
different components are compared with each other within the tasks that hold them, block by block,
and only links come out; so no candidate pair stays undecided and none is emitted. Members of a
bucket's largest component meet the others only, not each other.

Defined cases: words are runs of characters other than white space, A-Z lower-cased; texts of one
to four words are a single shingle; texts without a word (null, empty) link with nothing; texts
with the same words are one node and need no comparison; a null id is in its text's class but
never names it. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import _bytes, _exchange
from tidemark.llm._groups import dealt, sorted_groups
from tidemark.llm._tables import mark_of, materialise, one_of_each, unused, without
from tidemark.llm.components import components

WIDTH = 5
BITS = 48
_FINE, _COARSE = 1 << 18, 1 << 16
_SETS = "doc_id {kind}, mark string, node long, check long, bands array<long>, vector binary, weights binary"


def _gamma_table(n: int) -> np.ndarray:
    """Values of a Gamma(2, 1) variable at the middles of n equally likely parts."""
    p = (np.arange(n) + 0.5) / n
    x = np.full(n, 1.5)
    low, high = np.zeros(n), np.full(n, 60.0)
    for _ in range(60):  # bisection on 1 - (1 + x) exp(-x) = p
        x = (low + high) / 2
        below = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(below, x, low), np.where(below, high, x)
    return x


_tables: dict[str, np.ndarray] = {}


def _drawn() -> dict[str, np.ndarray]:
    if not _tables:
        _tables["r"] = _gamma_table(_COARSE).astype(np.float32)
        _tables["beta"] = ((np.arange(_COARSE) + 0.5) / _COARSE).astype(np.float32)
        _tables["lnc"] = np.log(_gamma_table(_FINE)).astype(np.float32)
    return _tables


def samples(keys: np.ndarray, weights: np.ndarray, starts: np.ndarray, many: int) -> np.ndarray:
    """A 32-bit sample for each set and draw. Set i is keys[starts[i]:starts[i + 1]], in any order."""
    drawn = _drawn()
    out = np.empty((len(starts), many), dtype=np.uint64)
    base, ln = _bytes.mix64(keys), np.log(weights).astype(np.float32)
    for k in range(many):
        h = base * np.uint64((2 * k + 1) * 0xD1342543DE82EF95 % 2**64)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        r = drawn["r"][h >> np.uint64(48)]
        beta = drawn["beta"][(h >> np.uint64(32)) & np.uint64(_COARSE - 1)]
        t = np.floor(ln / r + beta)
        least = drawn["lnc"][(h >> np.uint64(8)) & np.uint64(_FINE - 1)] - r * (t - beta + 1)
        bits = least.view(np.uint32)
        ordered = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)  # sorts as the floats do
        name = ((h >> np.uint64(32)) ^ h ^ (t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) & np.uint64(0xFFFFFFFF)
        out[:, k] = np.minimum.reduceat((ordered << np.uint64(32)) | name, starts) & np.uint64(0xFFFFFFFF)
    return out


def shingles(chunk: _bytes.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each row in order of row and key: row, key, count; and two hashes
    of each row's words, 0 for a row without any."""
    hashes, rows = _bytes.words(chunk)
    edges = np.searchsorted(rows, np.arange(len(chunk) + 1), side="left")
    full, of = _bytes.combine(hashes, rows, WIDTH)
    parts, owners = [full], [of]
    sizes = np.diff(edges)
    for n in range(1, WIDTH):
        mask = (sizes == n)[rows] if len(rows) else np.zeros(0, dtype=bool)
        few, few_rows = _bytes.combine(hashes[mask], rows[mask], n)
        parts.append(_bytes.mix64(few + np.uint64(n)))
        owners.append(few_rows)
    owner = np.concatenate(owners).astype(np.uint64)
    both = np.sort((owner << np.uint64(BITS)) | _exchange.trimmed(np.concatenate(parts), BITS))
    if len(both):
        first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
        counts = np.diff(np.append(first, len(both)))
        both = both[first]
    else:
        counts = np.zeros(0, dtype=np.int64)
    node, check = (np.where(sizes > 0, _bytes.sequence_hashes(hashes, edges, odd), np.uint64(0)) for odd in (1, 0x2545F4914F6CDD1D))
    return (both >> np.uint64(BITS)).astype(np.int64), both & np.uint64((1 << BITS) - 1), counts, node, check


def _requests(many: int):
    def run(table: pa.Table) -> pa.Table:
        tally = _exchange.Tally()
        for chunk in _bytes.chunks(table["text"], 1 << 20):
            _, keys, _, _, _ = shingles(chunk)
            tally.add(keys, np.ones(len(keys), dtype=np.int64))
        return _exchange.request_table(_exchange.request_rows(table["block"][0].as_py(), 0, *tally.result(), BITS, many))

    return run


def _merge(table: pa.Table) -> pa.Table:
    p = table["p"][0].as_py()
    _, _, back = _exchange.merge(table)
    return pa.table({"p": pa.array([p] * len(back), pa.int32()), "block": pa.array([b for b, _ in back], pa.int64()), "payload": pa.array([_bytes.pack_counts(c) for _, c in back], pa.binary())})


def inverse_frequency(df: np.ndarray, n: int, floor: float) -> np.ndarray:
    return floor + (1 - floor) * np.log(np.maximum((n + 1) / np.maximum(df, 1), 1)) / np.log(n + 1)


def _sets(many: int, n: int, floor: float, bands: int, rows: int, kind):
    schema = pa.schema([("doc_id", kind), ("mark", pa.string()), ("node", pa.int64()), ("check", pa.int64()), ("bands", pa.list_(pa.int64())), ("vector", pa.binary()), ("weights", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("doc_id")  # the least id of equal texts carries their set
        known = _exchange.Tally()
        for chunk in _bytes.chunks(left["text"], 1 << 20):
            _, keys, _, _, _ = shingles(chunk)
            known.add(keys, np.ones(len(keys), dtype=np.int64))
        every, _ = known.result()
        frequency = _exchange.answers(right, many)
        if len(frequency) != len(every):
            raise ValueError(f"a block of {len(every)} shingles got {len(frequency)} counts")
        idf = inverse_frequency(frequency, n, floor)
        out, seen = [], set()
        for chunk in _bytes.chunks(left["text"], 1 << 20):
            owner, keys, counts, node, check = shingles(chunk)
            weights = counts * idf[np.searchsorted(every, keys)] if len(keys) else np.zeros(0)
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, dtype=np.int64)
            drawn = samples(keys, weights, starts, bands * rows) if len(starts) else np.zeros((0, bands * rows), dtype=np.uint64)
            marks = np.empty((len(starts), bands), dtype=np.uint64)
            for band in range(bands):
                x = np.full(len(starts), band + 1, dtype=np.uint64)
                for k in range(band * rows, (band + 1) * rows):
                    x = _bytes.mix64(x * np.uint64(0x9E3779B97F4A7C15) + drawn[:, k])
                marks[:, band] = x
            ends = np.append(starts[1:], len(keys)).astype(np.int64)
            of = {int(owner[s]): i for i, s in enumerate(starts)}
            for row in range(len(chunk)):
                i = of.get(row)
                if i is None:
                    out.append((None, None, None, None, None))
                    continue
                pair = (int(node[row].astype(np.int64)), int(check[row].astype(np.int64)))
                if pair in seen:
                    out.append((*pair, None, None, None))
                    continue
                seen.add(pair)
                short = (keys[starts[i] : ends[i]] >> np.uint64(BITS - 32)).astype(np.uint32)  # sorted, as the keys are
                own = weights[starts[i] : ends[i]].astype(np.float32)
                out.append((*pair, marks[i].astype(np.int64).tolist(), _bytes.pack(short), _bytes.pack_counts(own.view(np.uint32))))
        _bytes.give_back()
        columns = zip(*out, strict=True) if out else [[]] * 5
        return pa.Table.from_arrays([left["doc_id"].combine_chunks(), left["mark"].combine_chunks(), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[2:], strict=True)]], schema=schema)

    return run


def similarity(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> float:
    """Weighted Jaccard similarity of two packed sets. Of keys that repeat, weights add up."""
    (ka, wa), (kb, wb) = (_exchange.summed(_bytes.unpack(k), _bytes.unpack_counts(w).astype(np.uint32).view(np.float32).astype(np.float64)) for k, w in (a, b))
    at = np.minimum(np.searchsorted(kb, ka), len(kb) - 1)
    same = kb[at] == ka
    shared = np.minimum(wa[same], wb[at[same]]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared))


def _verified(batches):
    for batch in batches:
        packed = [batch.column(c).to_pylist() for c in ("va", "wa", "vb", "wb")]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array([similarity((va, wa), (vb, wb)) for va, wa, vb, wb in zip(*packed, strict=True)], pa.float64())], names=["a", "b", "similarity"])


def _full_sets(needed: DataFrame, sets: DataFrame, most_broadcast: int, *more: str) -> DataFrame:
    """The sets of some distinct nodes. Ids of 8 bytes are broadcast while they are few; beyond
    that the join shuffles the sets."""
    full = sets.filter("vector IS NOT NULL").select("node", *more, "vector", "weights")
    if needed.count() <= most_broadcast:
        needed = F.broadcast(needed)
    return full.join(needed, "node", "left_semi").dropDuplicates(["node"])


def _links(pairs: DataFrame, sets: DataFrame, threshold: float, most_broadcast: int) -> DataFrame:
    """Of distinct candidate pairs (a, b), those whose sets are similar enough."""
    full = _full_sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), sets, most_broadcast)
    of = lambda x: full.select(F.col("node").alias(x), F.col("vector").alias(f"v{x}"), F.col("weights").alias(f"w{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "va", "wa", "vb", "wb").mapInArrow(_verified, "a long, b long, similarity double").filter(F.col("similarity") >= threshold)


def linked_across(node: np.ndarray, root: np.ndarray, side: np.ndarray, bands: np.ndarray, bucket: int, same_block: bool, packed: list[tuple[bytes, bytes]], threshold: float) -> list[tuple[int, int]]:
    """Links between members of a bucket that are in different components. One member at a time is
    compared with all others at once; members of the largest component need no turn of their own.
    Pairs that share an earlier band are that band's business."""
    parts = [_exchange.summed(_bytes.unpack(k), _bytes.unpack_counts(w).astype(np.uint32).view(np.float32).astype(np.float64)) for k, w in packed]
    starts = np.cumsum([0, *[len(k) for k, _ in parts]])
    keys, ids = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    weights = np.concatenate([w for _, w in parts])
    total = np.add.reduceat(weights, starts[:-1])
    roots, sizes = np.unique(root, return_counts=True)
    own = np.zeros(len(keys))
    found, done = [], np.zeros(len(node), dtype=bool)
    at = int(np.flatnonzero((bands == bucket).all(axis=0))[0])
    for i in np.flatnonzero(root != roots[sizes.argmax()]):
        mine = slice(starts[i], starts[i + 1])
        own[ids[mine]] = weights[mine]
        shared = np.add.reduceat(np.minimum(own[ids], weights), starts[:-1])
        own[ids[mine]] = 0
        near = (shared >= threshold * (total[i] + total - shared)) & (root != root[i]) & ~done
        if not same_block:
            near &= side != side[i]
        near &= ~(bands[:, :at] == bands[i, :at]).any(axis=1)
        found += [(int(node[i]), int(node[j])) for j in np.flatnonzero(near)]
        done[i] = True
    return found


def _across(threshold: float):
    def run(batches):
        for t in sorted_groups(batches, ["bucket", "low", "high"]):
            if len(t) < 2:
                continue
            column = lambda c: t[c].to_numpy()  # noqa: B023, E731
            root = column("root")
            if (root == root[0]).all():
                continue
            bands = np.array(t["bands"].to_pylist(), dtype=np.int64)
            packed = list(zip(t["vector"].to_pylist(), t["weights"].to_pylist(), strict=True))
            found = linked_across(column("node"), root, column("side"), bands, t["bucket"][0].as_py(), t["low"][0].as_py() == t["high"][0].as_py(), packed, threshold)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _classified(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, bands: int = 12, rows: int = 4, idf_floor: float = 0.85, block_size: int = 512, most_broadcast: int = 1_000_000) -> DataFrame:
    """One row per document: mark (of id and text), doc_id, component_id, component_size, kept."""
    n, many = _exchange.measured(df, text)
    n = max(n, 2)
    docs = df.select(_exchange.block_of(df[key], df[text], many).alias("block"), df[key].alias("doc_id"), mark_of(df[key], df[text]).alias("mark"), F.coalesce(df[text], F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType
    asked = docs.groupBy("block").applyInArrow(_requests(many), _exchange.REQUEST)
    back = asked.groupBy("p").applyInArrow(_merge, "p int, block long, payload binary")
    from pyspark.sql.pandas.types import to_arrow_type

    made = docs.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_sets(many, n, idf_floor, bands, rows, to_arrow_type(kind)), _SETS.format(kind=kind.simpleString()))
    sets = materialise(made, "weighted-sets")
    # texts that share 64 bits of hash, n * n / 2^65 of n, are told apart by the second hash
    clash = sets.filter("node IS NOT NULL").groupBy("node").agg(F.min("check").alias("x"), F.max("check").alias("y")).filter("x <> y")
    clash = [r["node"] for r in clash.select("node").collect()]
    sets = sets.withColumn("node", F.when(F.col("node").isin(clash), F.xxhash64("node", "check")).otherwise(F.col("node")))

    members = sets.filter("bands IS NOT NULL").select("node", F.explode("bands").alias("bucket")).distinct()
    heads = members.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("many")).filter("many > 1").drop("many")
    shared = materialise(members.join(heads, "bucket"), "buckets")
    star = materialise(shared.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "star-pairs")
    links = materialise(_links(star, sets, threshold, most_broadcast).select("a", "b"), "star-links")
    first = materialise(components(links), "star-components")
    # buckets whose members are not one component yet: their members are compared across components
    placed = shared.join(first, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    split = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("bucket")
    open_ = materialise(placed.join(split, "bucket"), "open-buckets")
    sided = dealt(open_, ["bucket"], "root", "node", block_size)
    full = _full_sets(open_.select("node").distinct(), sets, most_broadcast, "bands")
    by = ["bucket", "low", "high"]
    met = sided.join(full, "node").repartition(*by).sortWithinPartitions(*by)
    more = materialise(met.mapInArrow(_across(threshold), "a long, b long"), "cross-links")
    whole = materialise(components(links.union(more)), "components")

    nodes = sets.select("mark", "doc_id", "node").join(whole, "node", "left").select("mark", "doc_id", F.coalesce("root", "node").alias("root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")).alias("first")
    named = materialise(nodes.filter("root IS NOT NULL").groupBy("root").agg(first, F.count(F.lit(1)).alias("component_size")).filter("component_size > 1"), "near-classes")
    alone = F.col("component_size").isNull()
    return nodes.join(named, "root", "left").select(
        "mark",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.coalesce("component_size", F.lit(1)).cast("long").alias("component_size"),
        (alone | (F.col("mark") == F.col("first.mark"))).alias("kept"),
    )


def near_duplicates(df: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, component_id (the least id of its class), component_size, kept
    (it is the one that stays; of several rows with one id and text all are marked)."""
    return _classified(df, **options).drop("mark")


def near_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that stay, one document of each class, with all their columns. Rows are
    told apart by id and text together, so ids may be null or repeated."""
    mark = unused(df, "mark")
    report = materialise(_classified(df, key, text, **options).select(F.col("mark").alias(mark), "kept", "component_size"), "near-report")
    stays = without(df.withColumn(mark, mark_of(df[key], df[text])), report.filter(~F.col("kept")), mark)
    repeated = report.filter("kept AND component_size > 1").groupBy(mark).count().filter("count > 1")
    return one_of_each(stays, repeated, mark).select(*df.columns)
