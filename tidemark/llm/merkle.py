"""Operator 11: a Merkle manifest of a dataset, built and proved by supersteps over RDDs.

Every row is a leaf. The leaves of a group, in order of their keys, hang in runs of ``run`` under
parents, those again, until one node is left, the subroot; the subroots hang in the same way under
the root. Vertices talk as in Pregel:

* upward, each vertex messages its parent with its digest and its place among the children; a
  parent that has heard of all its children hashes them and messages its own parent in the next
  superstep, others wait with what they have;
* downward, in the reverse order, each parent that knows its own path sends every child the
  digests of its siblings before and after it, followed by that path.

A parent has at most ``run`` children, so no key of any superstep is hot however large a group is.
Places come from one range sort over (group, key): partitions count their rows of each group, and
the counts before a partition give the place of its first one. Each superstep ends in a table in the
shared folder, so a lost executor costs one superstep at most. The path of a run is stored once, not
once a leaf; the step from a run to its leaves is made when proofs are read.

Defined cases: a null value is hashed as ``-``; null groups and null keys come first; rows with
one key are ordered by their digests, rows equal in both have equal proofs up to their places; an empty table has
no root and no proofs; a group of one row has its leaf for subroot, and a table of one row has it for
root. Columns that are not hashed are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._tables import materialise, pieces

#: The tree over the subroots; groups count from 0.
TOP = -1

#: A child as its parent knows it: its place among the children, its digest, the superstep that made
#: it (0: a leaf), its own name, and of a leaf its row's key and the digest seen there later.
_CHILD = "struct<slot: int, digest: string, step: int, tree: long, level: int, place: long, key: {key}, seen: string>"
_PATH = "path array<struct<before: string, after: string>>, subroot string"


def field(value: Column) -> Column:
    """A value with its length, so that no two rows read the same once joined; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _small(df: DataFrame, most_broadcast: int) -> DataFrame:
    """``df``, to be broadcast if it has few enough rows."""
    return F.broadcast(df) if df.count() <= most_broadcast else df


def numbered(df: DataFrame, group: str, order: list[str], rows_per_task: int, most_broadcast: int) -> tuple[DataFrame, DataFrame]:
    """``df`` with each row's place (from 0) in its group and the group's number of rows, and a table
    of the groups (group, n). ``group`` is never null; ``order`` tells all rows apart."""
    spread = df.repartitionByRange(pieces(df.count(), rows_per_task), group, *order).sortWithinPartitions(group, *order)
    spread = materialise(spread.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()), "merkle-sorted")
    runs = spread.groupBy(group, "part").agg(F.min("nth").alias("first"), F.count(F.lit(1)).alias("m"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(runs.select(group, "part", "first", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("start"), F.sum("m").over(whole).alias("n")), "merkle-starts")
    placed = spread.join(_small(starts, most_broadcast), [group, "part"])
    return placed.withColumn("place", F.col("start") + F.col("nth") - F.col("first")).drop("part", "nth", "first", "start"), starts.select(group, "n").distinct()


def levels(n: int, run: int) -> int:
    """How many levels of parents stand over n nodes."""
    found = 0
    while n > 1:
        n, found = -(-n // run), found + 1
    return found


def _to_parent(run: int, groups: int):
    """The message of a vertex to its parent: (name of the parent, (number of its children, width of
    its level, child)). The root has no parent."""

    def send(vertex: tuple) -> Iterator[tuple]:
        tree, level, place, width, *rest = vertex
        at = (TOP, 0, tree, groups) if width == 1 and tree != TOP else (tree, level, place, width)
        if at[3] > 1:
            parent, slot = divmod(at[2], run)
            child = (slot, rest[0], rest[1], tree, level, place, *rest[2:])
            yield (at[0], at[1] + 1, parent), (min(run, at[3] - parent * run), -(-at[3] // run), child)

    return send


def _once_more(vertex) -> Iterator[tuple]:
    """What a waiting parent has heard so far."""
    for child in vertex.children:
        yield (vertex.tree, vertex.level, vertex.place), (vertex.expected, vertex.width, tuple(child))


def _hash_if_complete(step: int):
    def close(item: tuple) -> tuple:
        name, heard = item
        expected, width, _ = heard[0]
        children = sorted((child for _, _, child in heard), key=lambda child: child[0])
        digest = hashlib.sha256("".join(child[1] for child in children).encode()).hexdigest() if len(children) == expected else None
        return (*name, width, expected, digest, step, children)

    return close


def _to_children(vertex) -> Iterator[tuple]:
    """Messages of a parent that has its own path to those of its children that are parents."""
    digests = [child.digest for child in vertex.children]
    for child in vertex.children:
        if child.step:
            own = ("".join(digests[: child.slot]), "".join(digests[child.slot + 1 :]))
            subroot = child.digest if vertex.tree == TOP != child.tree else vertex.subroot
            yield child.step, (child.tree, child.level, child.place), ([own, *map(tuple, vertex.path)], subroot)


def _climb(placed: DataFrame, key_type: str, steps: int, groups: int, run: int, rows_per_task: int) -> list[DataFrame]:
    """The table of each upward superstep: the parents that completed in it, and those that wait."""
    spark = placed.sparkSession
    schema = f"tree long, level int, place long, width long, expected int, digest string, step int, children array<{_CHILD.format(key=key_type)}>"
    active = placed.select("tree", F.lit(0), "place", "n", "leaf", F.lit(0), "key", "seen").rdd.map(tuple)
    waiting, rows, tables = spark.sparkContext.emptyRDD(), placed.count(), []
    for step in range(1, steps + 1):
        messages = active.flatMap(_to_parent(run, groups)).union(waiting)
        heard = messages.combineByKey(lambda m: [m], lambda held, m: [*held, m], lambda held, more: held + more, pieces(rows, rows_per_task))
        tables.append(materialise(spark.createDataFrame(heard.map(_hash_if_complete(step)), schema, verifySchema=False), f"merkle-up-{step}"))
        none = F.lit(None)
        active = tables[-1].filter("digest IS NOT NULL").select("tree", "level", "place", "width", "digest", "step", none, none).rdd.map(tuple)
        waiting = tables[-1].filter("digest IS NULL").rdd.flatMap(_once_more)
        rows = rows // run + groups
    return tables


def _descend(tables: list[DataFrame], key_type: str, run: int, rows_per_task: int) -> list[DataFrame]:
    """The table of each reverse superstep: its parents with their children and their own path."""
    spark = tables[-1].sparkSession
    schema = f"tree long, children array<{_CHILD.format(key=key_type)}>, {_PATH}"
    top = tables[-1].select("tree", "level", "place", "digest").first()
    start = (len(tables), (top.tree, top.level, top.place), ([], None if top.tree == TOP else top.digest))
    pending, found = spark.sparkContext.parallelize([start], 1), []
    for step in range(len(tables), 0, -1):
        done = tables[step - 1].filter("digest IS NOT NULL")
        tasks = pieces(done.count() * run, rows_per_task)  # a parent brings all its children
        paths = pending.filter(lambda m, step=step: m[0] == step).map(lambda m: m[1:])
        met = done.rdd.map(lambda v: ((v.tree, v.level, v.place), [tuple(child) for child in v.children])).join(paths, tasks)
        rows = met.map(lambda item: (item[0][0], item[1][0], *item[1][1]))
        found.append(materialise(spark.createDataFrame(rows, schema, verifySchema=False), f"merkle-down-{step}"))
        pending = pending.filter(lambda m, step=step: m[0] != step).union(found[-1].rdd.flatMap(_to_children))
    return found


@dataclass(frozen=True)
class Manifest:
    """root: the digest of all rows, None of no rows. nodes: (tree, level, place, digest) of every
    parent, tree -1 standing over the subroots. proofs: for each row (key, leaf, seen, path,
    subroot), the path from the row's own run to the root."""

    root: str | None
    nodes: DataFrame
    proofs: DataFrame


def manifest(leaves: DataFrame, key: str, group: str, leaf: str, seen: str, run: int = 16, rows_per_task: int = 65_536, most_broadcast: int = 250_000) -> Manifest:
    """Build the trees over ``leaves``: a row for each leaf with its key, its group, its digest
    ``leaf``, and ``seen``, the digest that the row has when it is verified."""
    spark, key_type = leaves.sparkSession, leaves.schema[key].dataType.simpleString()
    named = F.when(leaves[group].isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), leaves[group].cast("string")))
    rows = leaves.select(leaves[key].alias("key"), named.alias("tree_name"), leaves[leaf].alias("leaf"), leaves[seen].alias("seen"), F.monotonically_increasing_id().alias("row"))
    rows = materialise(rows, "merkle-leaves")
    placed, sizes = numbered(rows, "tree_name", ["key", "leaf", "row"], rows_per_task, most_broadcast)
    trees, _ = numbered(materialise(sizes.select("tree_name", F.lit("").alias("all")), "merkle-trees"), "all", ["tree_name"], rows_per_task, most_broadcast)
    trees = materialise(trees.select("tree_name", F.col("place").alias("tree")), "merkle-tree-places")
    placed = materialise(placed.join(_small(trees, most_broadcast), "tree_name").select("tree", "place", "n", "leaf", "key", "seen"), "merkle-placed")
    groups, widest = trees.count(), sizes.agg(F.max("n")).first()[0]
    steps = levels(widest or 0, run) + levels(groups, run)
    node_shape, proof_shape = "tree long, level int, place long, digest string", f"key {key_type}, leaf string, seen string, {_PATH}"
    if not steps:
        alone = placed.select("key", "leaf", "seen", F.from_json(F.lit("[]"), "array<struct<before: string, after: string>>").alias("path"), F.col("leaf").alias("subroot"))
        return Manifest(placed.agg(F.max("leaf")).first()[0], spark.createDataFrame([], node_shape), alone)
    tables = _climb(placed, key_type, steps, groups, run, rows_per_task)
    nodes = proofs = None
    for table in tables:
        done = table.filter("digest IS NOT NULL").select("tree", "level", "place", "digest")
        nodes = done if nodes is None else nodes.unionByName(done)
    for table in _descend(tables, key_type, run, rows_per_task):
        part = _of_leaves(table)
        proofs = part if proofs is None else proofs.unionByName(part)
    return Manifest(tables[-1].first().digest, nodes, proofs)


def _of_leaves(vertices: DataFrame) -> DataFrame:
    """The step from a run to those of its children that are leaves."""
    digests = F.transform("children", lambda child: child["digest"])
    child = vertices.filter(F.exists("children", lambda child: child["step"] == 0)).select("tree", "path", "subroot", digests.alias("digests"), F.explode("children").alias("child")).filter("child.step = 0")
    slot = F.col("child.slot")
    own = F.struct(F.array_join(F.slice("digests", F.lit(1), slot), "").alias("before"), F.array_join(F.slice("digests", slot + 2, F.size("digests")), "").alias("after"))
    subroot = F.when(F.col("tree") == TOP, F.col("child.digest")).otherwise(F.col("subroot"))
    return child.select("child.key", F.col("child.digest").alias("leaf"), "child.seen", F.concat(F.array(own), "path").alias("path"), subroot.alias("subroot"))


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings lead to."""
    return F.aggregate(path, digest, lambda h, step: F.sha2(F.concat(step["before"], h, step["after"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on a path, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def verified(built: Manifest) -> DataFrame:
    """A row for each leaf: key, leaf, subroot, root, proof_sha256, folded_root (from what was seen)
    and verified (that is the root)."""
    rows = built.proofs.select("key", "leaf", "subroot", F.lit(built.root).cast("string").alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), folded(F.col("seen"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def tamper_report(df: DataFrame, key: str = "doc_id", group: str = "source", text: str = "text", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), every: int = 5, **options) -> DataFrame:
    """Build the manifest over ``df``, lower-case A-Z in the text of rows whose crc32 of the key
    ``every`` divides, and verify all rows against it."""
    touched = F.coalesce(F.crc32(df[key].cast("string")) % every == 0, F.lit(False))
    tampered = F.when(touched, F.translate(df[text], string.ascii_uppercase, string.ascii_lowercase)).otherwise(df[text])
    # the digest of a row that is not touched is not worked out twice
    leaf = row_digest(*[df[c] for c in columns])
    later = F.when(touched, row_digest(*[tampered if c == text else df[c] for c in columns]))
    rows = df.select(df[key].alias("key"), df[group].alias("group"), leaf.alias("leaf"), later.alias("later"))
    rows = rows.select("key", "group", "leaf", F.coalesce("later", "leaf").alias("seen"))
    return verified(manifest(rows, "key", "group", "leaf", "seen", **options)).withColumnRenamed("key", key)
