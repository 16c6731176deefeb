"""Operator 4: mixing sources to target weights by weighted fair queueing, DataFrame operations only.

Documents of a source queue in a shuffled order (md5 of the id and the text's digest). A copy's virtual finish time is
the source's cumulative tokens up to and with it, divided by the source's weight; a source may be
queued ``epochs`` times over. All copies are range-ordered by finish time and the mix ends where
the running total would pass the budget. That is the fluid allocation min(epochs * size, weight * V)
up to one document a source, V being the common virtual time at which the budget is used up.

No queue is ever one task: a source is cut into buckets of about ``bucket_rows`` rows by leading
digits of its shuffle key, running sums within a bucket start at the sum of the buckets before it,
and the global order is cut into bins of finish time, of which only the one that holds the cut is
sorted row by row.

Rows alike in id, text and source are one entry of the queue with their number, and become rows again
once the queue has its sums. So the order of the queue is total, reruns agree whatever the order of
the input, and a row that is repeated often is no hot key of a window.

Defined cases: null text has size 0; null source is a source of its own, last in order; repeated or
null ids are told apart by their texts; of rows alike in all columns it does not matter which is
taken; an empty table gives an empty mix; with a total of 0 all targets are 0. Extra columns are
ignored by the report and returned untouched by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._tables import mark_of, materialise, one_of_each, unused

WORD = r"[^\x20\x09-\x0D]+"
ORDER = ("finish", "place", "epoch", "h", "doc_id", "carried", "nth")
#: Bins of finish time that one running sum goes over.
BINS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], share: float, epochs: int) -> DataFrame:
    """One row per source: place (0 first), weight, source_size, rows, virtual end V, target.

    Sources are filled in the order in which they run dry: after the first k are full, the rest
    share what is left at a common virtual time; the first k whose time comes before the next
    source runs dry is the answer.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("alike")).alias("source_size"), F.sum("alike").alias("rows"))
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dry = Window.partitionBy(F.lit(0)).orderBy("dry", "place")
    before = dry.rowsBetween(Window.unboundedPreceding, -1)
    listed = F.array(*[F.lit(int(w)) for w in weights])
    return (
        per.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", F.element_at(listed, (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * epochs)
        .withColumn("dry", F.col("most") / F.col("weight"))
        .withColumn("budget", F.lit(share) * F.sum("source_size").over(every))
        .withColumn("full", F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("v", (F.col("budget") - F.col("full")) / F.col("left"))
        .withColumn("ends", F.min(F.when(F.col("v") <= F.col("dry"), F.struct("dry", "place", "v"))).over(every)["v"])
        .withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * F.coalesce("ends", F.lit(0.0))))
        .select("source", "place", "weight", "source_size", "rows", F.coalesce("ends", F.lit(0.0)).alias("ends"), "budget", "target")
    )


def _queued(entries: DataFrame, sources: DataFrame, bucket_rows: int) -> DataFrame:
    """A row for each input row, with its number ``nth`` (from 1) among those alike and ``upto``, the
    tokens of its source up to and with it in shuffled order."""
    at = F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / 4294967296.0
    rows = entries.join(sources.withColumnRenamed("source", "its"), F.col("source").eqNullSafe(F.col("its"))).drop("its")
    rows = rows.withColumn("bucket", F.floor(at * F.ceil(F.col("rows") / bucket_rows))).withColumn("tokens", F.col("size") * F.col("alike"))
    sums = rows.groupBy("place", "bucket").agg(F.sum("tokens").alias("in_bucket"))
    earlier = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("place", "bucket", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("place", "bucket").orderBy("h", "doc_id", "carried").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("run", F.sum("tokens").over(within)).join(starts, ["place", "bucket"]).withColumn("before", F.col("start") + F.col("run") - F.col("tokens"))
    parts = placed.withColumn("part", F.explode(F.sequence(F.lit(1).cast("long"), "alike", F.lit(bucket_rows).cast("long"))))
    if not entries.filter(F.col("alike") > bucket_rows).isEmpty():
        parts = parts.repartition("h", "part")  # so that no task makes all rows of one entry
    last = F.least(F.col("part") + bucket_rows - 1, F.col("alike"))
    return parts.withColumn("nth", F.explode(F.sequence("part", last))).withColumn("upto", F.col("before") + F.col("nth") * F.col("size")).drop("part", "alike", "tokens", "run", "before", "start")


def _copies(queued: DataFrame, epochs: int) -> DataFrame:
    finish = (F.col("epoch") * F.col("source_size") + F.col("upto")) / F.col("weight")
    return queued.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(epochs)]))).withColumn("finish", finish)


def _passing(sums: DataFrame, by: str, before: int, budget: int):
    """The first of ``by`` with which the running total of ``n`` passes the budget: (by, run, n)."""
    run = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)) + F.lit(before)
    return sums.withColumn("run", run).filter(F.col("run") > budget).agg(F.min(F.struct(by, "run", "n")).alias("x")).first()["x"]


def _cut(copies: DataFrame, budget: int, ends: float, bins: int):
    """The place in the global order, as a row of ORDER, of the last copy within the budget."""
    step = F.least(F.floor(F.col("finish") / ends * bins), F.lit(8 * bins)).cast("long") if ends > 0 else F.lit(0).cast("long")
    binned = copies.withColumn("bin", step)
    per_bin = binned.groupBy("bin").agg(F.sum("size").alias("n")).withColumn("wide", F.floor(F.col("bin") / BINS))
    held = _passing(per_bin.groupBy("wide").agg(F.sum("n").alias("n")), "wide", 0, budget)
    if held is None:
        return None
    held = _passing(per_bin.filter(F.col("wide") == held["wide"]), "bin", held["run"] - held["n"], budget)
    order = Window.partitionBy("bin").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    inside = binned.filter(F.col("bin") == held["bin"]).withColumn("run", F.sum("size").over(order) + F.lit(held["run"] - held["n"]))
    last = inside.filter(F.col("run") <= budget).agg(F.max(F.struct(*ORDER)).alias("x")).first()["x"]
    if last is not None:
        return last
    return binned.filter(F.col("bin") < held["bin"]).agg(F.max(F.struct(*ORDER)).alias("x")).first()["x"]


def mix_plan(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=(3, 1, 2), share: float = 1.5, epochs: int = 2, bucket_rows: int = 4096, carry: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, then finish, the virtual
    finish time of its first copy, and copies, how often the mix takes it. ``carry`` is a Column
    to carry along, as column ``carried``."""
    digest = F.md5(F.concat_ws(":", F.coalesce(df[key].cast("string"), F.lit("")), F.md5(F.coalesce(df[text], F.lit("")))))
    rows = df.select((F.lit("") if carry is None else carry).alias("carried"), df[key].alias("doc_id"), df[source].alias("source"), word_count(df[text]).alias("size"), digest.alias("h"))
    sized = materialise(rows.groupBy("h", "doc_id", "carried", "source", "size").agg(F.count(F.lit(1)).alias("alike")), "mix-sizes")
    sources = materialise(source_targets(sized, list(weights), share, epochs), "mix-sources")
    queued = materialise(_queued(sized, sources, bucket_rows), "mix-queue")
    known = sources.agg(F.max("ends"), F.max("budget"), F.sum("rows")).first()
    copies = _copies(queued, epochs)
    last = None if known[0] is None else _cut(copies, int(known[1]), known[0], max(1, known[2] * epochs // 8192))
    if last is None:
        within = F.lit(0 if known[0] is None else epochs)
    else:
        edge = F.struct(*[F.lit(last[c]).cast(copies.schema[c].dataType).alias(c) for c in ORDER])
        nth = lambda e: F.struct(((F.lit(e) * F.col("source_size") + F.col("upto")) / F.col("weight")).alias("finish"), F.col("place"), F.lit(e).alias("epoch"), F.col("h"), F.col("doc_id"), F.col("carried"), F.col("nth"))
        within = sum((F.when(nth(e) <= edge, 1).otherwise(0) for e in range(epochs)), F.lit(0))
    return queued.withColumn("copies", within.cast("long")).select(
        *(["carried"] if carry is not None else []), "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), (F.col("upto") / F.col("weight")).alias("finish"), "copies"
    )


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mixed rows with the columns of ``df``, a row for each copy, globally sorted by the finish
    time of the first copy. Rows are told apart by all their columns; of those alike one stands for
    all, and comes as often as the plan takes them together."""
    mark, nth, finish, copies = (unused(df, name) for name in ("mark", "nth", "finish", "copies"))
    own = F.concat(mark_of(df[key], df[text]), F.hex(F.xxhash64(*[df[c] for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])))
    plan = mix_plan(df, key, text, carry=own, **options)
    plan = materialise(plan.select(F.col("carried").alias(mark), F.col("finish").alias(finish), F.col("copies").alias(copies)), "mix-plan")
    repeated = plan.groupBy(mark).count().filter("count > 1")
    rows = one_of_each(df.withColumn(mark, own), repeated, mark)
    joined = rows.join(plan.filter(F.col(copies) > 0), mark)
    taken = joined.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
    return taken.orderBy(finish, mark, nth).select(*df.columns)
