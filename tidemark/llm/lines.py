"""Operator 2: near-duplicate lines by a segment-partition edit join, DataFrame operations only.

Two lines are linked when few enough insertions, deletions and substitutions of characters turn one
into the other: one for every ``chars_per_edit`` characters of the shorter line, ``edits`` at most.
Of two lines within t edits at least one of t + 1 segments of the shorter one stands unchanged in
the longer one, at a place that the number of edits before and after it bounds. So every line is
indexed under (its length, segment number, segment) and probes, for each length up to t below its
own, the few substrings that could be such a segment.

A segment that many lines share would pair them all. Lines that meet in such a hot segment are
cut finer: of ``fine`` segments all but t stand unchanged, and the key is made from all of those
together. What still meets is tested in the join itself: it needs nearly the same counts of
characters, in 16 classes, and similar middles between the common ends. All of that is necessary
for a link, so none is lost, and unlike lines emit no pair. The comparisons inside what still meets
grow with the square of its size; the rows do not.

Candidates are verified by the banded bit-parallel recurrence on what remains between their common
beginning and end.

Lines are trimmed; blank ones are no lines. Equal lines are one node. Its id is a hash of 64 bits;
lines that share one are found by grouping the distinct lines and hashed anew, so no two lines have
one id.

Defined cases: null text has no lines; a null doc_id sorts before all others when the first line of
a class is chosen; repeated rows repeat their lines; extra columns are ignored by the report and
returned untouched by ``dedup_lines``, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._tables import mark_of, materialise, unused
from tidemark.llm.components import components

#: Fixed value: characters by class; every other character is of none.
_CLASSES = ["e", "t", "a", "o", "i", "n", "sz", "rx", "hq", "lj", "dk", "uv", "cb", "mp", "gf", "wy"]


def hashed(line: Column, salt: int) -> Column:
    """64 bits of hash, independent for each salt."""
    return F.xxhash64(F.lit(salt), line)


def node_ids(texts: DataFrame) -> Callable[[Column, Column], Column]:
    """The id of a line, given the line and its hash, different for each of the distinct lines
    ``texts`` (line, hash).

    Hashes that several lines share are few (n * n / 2^65 of n lines) and become literals; their
    lines are hashed with the next salt, until no id is shared.
    """
    shared: list[list[int]] = []

    def id_of(line: Column, first: Column) -> Column:
        id_ = first
        for salt, ids in enumerate(shared, 1):
            id_ = F.when(id_.isin(ids), hashed(line, salt)).otherwise(id_)
        return id_

    while ids := [r["node"] for r in texts.groupBy(id_of(F.col("line"), F.col("hash")).alias("node")).count().filter("count > 1").collect()]:
        shared.append(ids)
    return id_of


def character_counts(line: Column) -> Column:
    """Counts modulo 16 of 16 classes of characters, four bits each."""
    counts = F.lit(0).cast("long")
    for k, members in enumerate(_CLASSES):
        count = F.octet_length(line) - F.octet_length(F.translate(line, members, ""))
        counts = counts.bitwiseOR(F.shiftleft(count.cast("long").bitwiseAND(F.lit(15)), 4 * k))
    return counts


def _counts_apart(a: Column, b: Column) -> Column:
    """At least half of this many edits lie between two lines: an edit changes two counts by one."""
    total = F.lit(0).cast("long")
    for k in range(len(_CLASSES)):
        d = F.abs(F.shiftrightunsigned(a, 4 * k).bitwiseAND(F.lit(15)) - F.shiftrightunsigned(b, 4 * k).bitwiseAND(F.lit(15)))
        total = total + F.least(d, 16 - d)
    return total


def allowed(length: Column, edits: int, chars_per_edit: int) -> Column:
    """How many edits two lines may be apart, the shorter of which has that length."""
    return F.least(F.floor(length / chars_per_edit), F.lit(edits)).cast("int")


def _segment(length: Column, i: int, many: int) -> tuple[Column, Column]:
    """Start (from 0) and size of segment i of ``many`` of a line of that length."""
    start = F.floor(length * i / many).cast("int")
    return start, F.floor(length * (i + 1) / many).cast("int") - start


def probe_shifts(edits: int) -> list[tuple[int, int, int]]:
    """(how much shorter the indexed line is, segment, shift of its place) that need probing.

    With i segments before it and edits - i after it, a segment that is the first untouched one has
    moved by at most i places, and by at most edits - i from where the difference in length puts it.
    """
    return [(d, i, s) for d in range(edits + 1) for i in range(edits + 1) for s in range(-i, i + 1) if abs(s - d) <= edits - i]


def _within(length: Column, t: int, edits: int, chars: int) -> Column:
    """Whether lines of that length may be exactly t edits from a longer one."""
    return (length >= t * chars) & (length < (t + 1) * chars) if t < edits else length >= t * chars


def _each_tier(n: Column, edits: int, chars: int, of: Callable[[int], list[tuple[int, Column]]]) -> Column:
    """An array of keys. ``of(t)`` lists (how much shorter the indexed line is, key) for lines that
    may be t edits apart; keys for lengths of another t are null. n: length of the line."""
    last = [key for _, key in of(edits)]
    every = [F.when(_within(n - d, t, edits, chars), key) for t in range(1, edits + 1) for d, key in of(t)]
    return F.when(n >= edits * chars + edits, F.array(*last)).otherwise(F.array(*every))


def index_keys(line: Column, n: Column, edits: int, chars: int) -> Column:
    """Keys of the line's own segments."""

    def of(t: int) -> list[tuple[int, Column]]:
        parts = [_segment(n, i, t + 1) for i in range(t + 1)]
        return [(0, F.xxhash64(F.lit(i), n, F.substring(line, start + 1, size))) for i, (start, size) in enumerate(parts)]

    return _each_tier(n, edits, chars, of)


def probe_keys(line: Column, n: Column, edits: int, chars: int) -> Column:
    """Keys of what could be a segment of a line as long or up to ``edits`` shorter."""

    def of(t: int) -> list[tuple[int, Column]]:
        keys = []
        for d, i, shift in probe_shifts(t):
            start, size = _segment(n - d, i, t + 1)
            keys.append((d, F.xxhash64(F.lit(i), n - d, F.substring(line, start + 1 + shift, size))))
        return keys

    return _each_tier(n, edits, chars, of)


def _fine_cases(t: int, fine: int) -> Iterator[tuple[str, int, list[tuple[int, int]]]]:
    """Ways in which t edits may fall into t of ``fine`` segments: a name for the touched segments,
    how much shorter the indexed line is, and (segment, shift of its place) of the others."""
    for touched in combinations(range(fine), t):
        for moves in product(range(-t, t + 1), repeat=t):
            if 0 <= sum(moves) and sum(map(abs, moves)) <= t:
                shift = lambda i: sum(m for at, m in zip(touched, moves, strict=True) if at < i)  # noqa: B023, E731
                yield f"{t}:{touched}", sum(moves), [(i, shift(i)) for i in range(fine) if i not in touched]


def fine_keys(line: Column, n: Column, edits: int, chars: int, fine: int, probing: bool) -> Column:
    """Keys of all segments but the touched ones together, for each way to touch some; those of the
    line's own segments, or if ``probing`` of what could be segments of a line as long or shorter.
    The ways are many, so they are a literal to go through, not expressions of their own."""
    ways = [(t, *way) for t in range(1, edits + 1) for way in _fine_cases(t, fine) if probing or not (way[1] or any(shift for _, shift in way[2]))]
    shape = "array<struct<t: int, name: string, d: int, parts: array<struct<i: int, shift: int>>>>"
    listed = F.from_json(F.lit(json.dumps([{"t": t, "name": name, "d": d, "parts": [{"i": i, "shift": shift} for i, shift in parts]} for t, name, d, parts in ways])), shape)

    def key(way: Column) -> Column:
        length = n - way["d"]
        start = lambda i: F.floor(length * i / fine).cast("int")
        part = lambda p: F.substring(line, start(p["i"]) + 1 + p["shift"], start(p["i"] + 1) - start(p["i"]))
        return F.xxhash64(way["name"], length, F.transform(way["parts"], part))

    return F.transform(F.filter(listed, lambda way: allowed(n - way["d"], edits, chars) == way["t"]), key)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of ``a`` and the not shorter ``b`` by the banded bit-parallel recurrence,
    right where it is at most ``edits`` and more than that elsewhere.

    Column j of the table is held for the rows j - edits to j + edits as two bit sets: where a cell
    is one more (up) or one less (down) than the cell above. ``same`` marks cells that equal their
    upper left neighbour; the distance grows along the diagonal of the last cell wherever that
    mark is missing. Rows above the first stand for the first row.
    """
    band = 2 * edits + 1
    mask = (1 << band) - 1
    xs, ys = F.split(a, ""), F.split(b, "")
    gap = F.length(b) - F.length(a)
    inv = lambda x: F.bitwise_not(x).bitwiseAND(F.lit(mask))

    def step(state: Column, j: Column) -> Column:
        char = F.get(ys, j - 1)
        equal = F.lit(0).cast("long")
        for i in range(band):
            hit = F.coalesce(F.get(xs, j - 1 - edits + i) == char, F.lit(False))
            equal = equal.bitwiseOR(F.when(hit, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
        up, down = state["up"], state["down"]

        def advance(eq: Column) -> Column:
            same = ((eq.bitwiseAND(up) + up).bitwiseXOR(up)).bitwiseOR(eq).bitwiseOR(down).bitwiseAND(F.lit(mask))

            def close(s: Column) -> Column:
                right_up = down.bitwiseOR(inv(s.bitwiseOR(up)))
                right_down = s.bitwiseAND(up)
                moved = F.shiftrightunsigned(s, 1)
                on = F.pow(F.lit(2), F.lit(edits) - gap).cast("long")
                grows = (j > gap) & (s.bitwiseAND(on) == 0)
                return F.struct(
                    right_down.bitwiseOR(inv(moved.bitwiseOR(right_up))).alias("up"),
                    moved.bitwiseAND(right_up).alias("down"),
                    (state["d"] + F.when(grows, F.lit(1)).otherwise(F.lit(0))).cast("int").alias("d"),
                )

            return _let(same, close)

        return _let(equal, advance)

    start = F.struct(F.lit(mask & ~((1 << edits) - 1)).cast("long").alias("up"), F.lit(0).cast("long").alias("down"), gap.cast("int").alias("d"))
    run = F.aggregate(F.sequence(F.lit(1), F.length(b)), start, step)["d"]
    return F.when(gap > edits, gap).when(F.length(b) == 0, F.lit(0)).when(F.length(a) == 0, gap).otherwise(run)


def _shared(a: Column, b: Column, most: Column, side) -> Column:
    """Length of the longest common beginning (side: left) or end (right), by halving."""
    powers = F.array(*[F.lit(1 << k) for k in range(22, -1, -1)])
    return F.aggregate(powers, F.lit(0), lambda n, p: F.when((n + p <= most) & (side(a, n + p) == side(b, n + p)), n + p).otherwise(n))


def _may_be_near(x: Column, y: Column, edits: int) -> Column:
    """Necessary for two lines without common ends to be within ``edits``.

    One edit falls before the first matched character and one after the last, which leaves
    ``edits - 2`` for the inside: of ``edits - 1`` pieces of the inside of the shorter line one
    stands in the other, moved by at most ``edits`` places.
    """
    inner = F.length(x) - 2 * edits
    found = inner <= 0
    for p in range(edits - 1):
        start = F.floor(inner * p / (edits - 1)).cast("int") + edits
        size = F.floor(inner * (p + 1) / (edits - 1)).cast("int") + edits - start
        piece = F.substring(x, start + 1, size)
        for shift in range(-edits, edits + 1):
            found = found | (piece == F.substring(y, start + 1 + shift, size))
    return found


def _may_link(x: Column, y: Column, edits: int) -> Column:
    """Necessary for ``x`` and the not shorter ``y`` to be within ``edits``: what remains between
    their common beginning and end may be."""

    def inside(head: Column) -> Column:
        def middles(tail: Column) -> Column:
            cut = lambda c: F.substring(c, head + 1, F.length(c) - head - tail)
            return _let(F.struct(cut(x).alias("x"), cut(y).alias("y")), lambda m: _may_be_near(m["x"], m["y"], edits))

        return _let(_shared(x, y, F.length(x) - head, F.right), middles)

    return _let(_shared(x, y, F.length(x), F.left), inside)


def verified(pairs: DataFrame, edits: int, chars_per_edit: int) -> DataFrame:
    """Of (a, b, xa, xb), ids and lines, those near enough; the common ends are cut off first."""
    shorter = F.length("xa") <= F.length("xb")

    def fixed(df: DataFrame, *kept: str, **columns: Column) -> DataFrame:
        """Columns that later filters see as values: a filter is not pushed into what explode makes,
        where it would repeat their expressions for each time it names them."""
        return df.select("a", "b", *kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))

    x = fixed(pairs, x=F.when(shorter, F.col("xa")).otherwise(F.col("xb")), y=F.when(shorter, F.col("xb")).otherwise(F.col("xa")))
    x = fixed(x, "x", "y", most=allowed(F.length("x"), edits, chars_per_edit)).filter(F.length("y") - F.length("x") <= F.col("most"))
    x = fixed(x, "x", "y", "most", head=_shared(F.col("x"), F.col("y"), F.length("x"), F.left))
    x = fixed(x, "x", "y", "most", "head", tail=_shared(F.col("x"), F.col("y"), F.length("x") - F.col("head"), F.right))
    middle = lambda c: F.substring(c, F.col("head") + 1, F.length(c) - F.col("head") - F.col("tail"))
    x = fixed(x, "most", x=middle(F.col("x")), y=middle(F.col("y"))).filter(_may_be_near(F.col("x"), F.col("y"), edits))
    x = fixed(x, "most", distance=edit_distance(F.col("x"), F.col("y"), edits))
    return x.filter(F.col("distance") <= F.col("most")).select("a", "b")


def split_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, line_no, line) of every line that is not blank."""
    rows = df.select(df[key].alias("doc_id"), F.posexplode(F.split(df[text], "\n")).alias("line_no", "line"))
    return rows.withColumn("line", F.trim("line", F.lit(" \t\r\x0b\x0c"))).filter("line <> ''")


def _keyed(texts: DataFrame, keys: Column, *kept: str) -> DataFrame:
    """A row for each key of each line. The outer form keeps Spark from working out the array a
    second time to ask whether it is empty."""
    return texts.select(keys.alias("keys"), *kept).select(F.explode_outer("keys").alias("key"), *kept).filter("key IS NOT NULL")


def _of_nodes(texts: DataFrame, nodes: DataFrame, most_broadcast: int) -> DataFrame:
    """The lines of some distinct nodes. Ids of 8 bytes are broadcast while they are few; beyond
    that the lines are shuffled."""
    if nodes.count() <= most_broadcast:
        nodes = F.broadcast(nodes)
    return texts.join(nodes, "node", "left_semi")


def _met(indexed: DataFrame, probes: DataFrame, more: Column | None = None) -> DataFrame:
    """Candidate pairs (a, b), the lesser id first, each once. Who meets an index row without a node
    is paired with itself."""
    i, p = indexed.alias("i"), probes.alias("p")
    on = (F.col("i.key") == F.col("p.key")) & ~F.col("i.node").eqNullSafe(F.col("p.node"))
    return i.join(p, on if more is None else on & more).select(F.least("i.node", "p.node").alias("a"), F.greatest("i.node", "p.node").alias("b")).distinct()


def line_links(texts: DataFrame, edits: int, chars_per_edit: int, hot: int, fine: int, most_broadcast: int) -> DataFrame:
    """Links (a, b) between the ids of different lines; ``texts`` has each line once: line, n, node."""
    line, n = F.col("line"), F.col("n")
    long = texts.filter(n >= chars_per_edit)
    indexed = _keyed(long, index_keys(line, n, edits, chars_per_edit), "node")
    probes = _keyed(long, probe_keys(line, n, edits, chars_per_edit), "node")
    shared = materialise(indexed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > hot).select("key"), "hot-keys")
    # one row stands for a hot key in the index, so the same join finds the pairs of the other keys and
    # the lines of the hot ones; a line's own segments are among its probes, so no line is missed
    marked = indexed.join(shared, "key", "left_anti").select("key", "node").union(shared.select("key", F.lit(None).cast("long").alias("node")))
    met = materialise(_met(marked, probes), "cold-pairs")
    inside = met.filter("a = b").select(F.col("a").alias("node"))
    dense = materialise(_of_nodes(long, inside, most_broadcast).withColumn("counts", character_counts(line)), "hot-lines")
    fine_indexed = _keyed(dense, fine_keys(line, n, edits, chars_per_edit, fine, False), "node", "counts", "line")
    fine_probes = _keyed(dense, fine_keys(line, n, edits, chars_per_edit, fine, True), "node", "counts", "line")
    # tested where they meet, so that a group of unlike lines that share segments emits no pairs
    likely = (_counts_apart(F.col("i.counts"), F.col("p.counts")) <= 2 * edits) & _may_link(F.col("i.line"), F.col("p.line"), edits)
    hot_pairs = _met(fine_indexed, fine_probes, likely)
    pairs = materialise(met.filter("a <> b").union(hot_pairs).distinct(), "line-pairs")
    needed = materialise(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "paired-nodes")
    full = _of_nodes(long, needed, most_broadcast)
    of = lambda c: full.select(F.col("node").alias(c), F.col("line").alias(f"x{c}"))
    return materialise(verified(pairs.join(of("a"), "a").join(of("b"), "b"), edits, chars_per_edit), "line-links")


def _firsts(placed: DataFrame) -> DataFrame:
    """First line of each class of several lines: class_id, first_doc_id, first_line_no."""
    if placed.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        # one number for the place, so that Spark can add up in a hash table
        doc = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit("-9223372036854775809").cast("decimal(20,0)"))
        place = (doc * F.lit(1 << 31).cast("decimal(11,0)")).cast("decimal(37,0)") + F.col("line_no")
    else:
        place = F.struct("doc_id", "line_no")
    at = placed.withColumn("place", place).groupBy("class_id").agg(F.count(F.lit(1)).alias("m"), F.min_by("doc_id", "place").alias("first_doc_id"), F.min_by("line_no", "place").alias("first_line_no"))
    return at.filter("m > 1").drop("m")


def line_report(df: DataFrame, key: str = "doc_id", text: str = "text", edits: int = 2, chars_per_edit: int = 10, hot: int = 16, fine: int = 4, most_broadcast: int = 1_000_000) -> DataFrame:
    """One row per line: doc_id, line_no (from 0), class_id, first_doc_id, first_line_no, n_links
    (other different lines linked directly), kept (it is the first of its class)."""
    lines = split_lines(df, key, text)
    distinct = lines.select("line").distinct()
    texts = materialise(distinct.select("line", F.length("line").alias("n"), hashed(F.col("line"), 0).alias("hash")), "line-texts")
    id_of = node_ids(texts)
    texts = texts.select("line", "n", id_of(F.col("line"), F.col("hash")).alias("node"))
    links = line_links(texts, edits, chars_per_edit, hot, fine, most_broadcast)
    roots = components(links)
    ends = links.select(F.col("a").alias("node")).union(links.select("b"))
    classes = materialise(roots.join(ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links")), "node"), "line-classes")
    placed = lines.select("doc_id", "line_no", id_of(F.col("line"), hashed(F.col("line"), 0)).alias("node")).join(classes, "node", "left")
    placed = materialise(placed.select("doc_id", "line_no", F.coalesce("root", "node").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "placed-lines")
    firsts = materialise(_firsts(placed), "class-firsts").withColumn("several", F.lit(True))
    alone = F.col("several").isNull()
    first_doc, first_line = F.when(alone, F.col("doc_id")).otherwise(F.col("first_doc_id")), F.when(alone, F.col("line_no")).otherwise(F.col("first_line_no"))
    return placed.join(firsts, "class_id", "left").select(
        "doc_id", "line_no", "class_id", first_doc.alias("first_doc_id"), first_line.alias("first_line_no"), "n_links",
        (F.col("doc_id").eqNullSafe(first_doc) & (F.col("line_no") == first_line)).alias("kept"),
    )


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without the lines that are near copies of an earlier one. Rows are told apart by
    id and text together, so ids may be null or repeated; rows alike in both keep the same lines."""
    gone, mark = unused(df, "gone"), unused(df, "mark")
    own = mark_of(df[key], df[text])
    named = df.select(F.struct(df[key].alias("id"), own.alias("mark")).alias("row"), df[text].alias("text"))
    report = line_report(named, "row", "text", **options)
    lost = report.filter(~F.col("kept")).groupBy(F.col("doc_id.mark").alias(mark)).agg(F.collect_set("line_no").alias(gone))
    joined = df.withColumn(mark, own).join(lost, mark, "left")
    stays = F.filter(F.transform(F.split(df[text], "\n"), lambda x, i: F.when(~F.array_contains(gone, i), x)), lambda x: x.isNotNull())
    shorter = F.when(F.col(gone).isNull(), df[text]).otherwise(F.array_join(stays, "\n"))
    return joined.select(*[shorter.alias(c) if c == text else df[c] for c in df.columns])
