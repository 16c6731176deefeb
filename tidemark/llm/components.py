"""Connected components by alternating large and small stars, without gathering a node's links.

Each round hangs every node's larger neighbours on the least node around, then every node and its
smaller neighbours on the least of those. The rounds end when the links no longer change; then
every link points at its component's least node. A node with a million links is a hot join key at
most, which adaptive execution splits; no link or component passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._tables import materialise


def _large(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of comparable ids: one row per linked node, (node, root)."""
    now = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if seen[0] == 0 or seen == before:
            break
        before = seen
        now = materialise(_small(_large(now).distinct()).distinct(), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()
