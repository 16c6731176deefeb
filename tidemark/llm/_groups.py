"""Groups of rows: read sorted, batch by batch, without gathering a partition; dealt into blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Each run of rows with equal keys (numbers) as one table."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table[k].to_numpy() for k in keys]
        new = np.any([c[1:] != c[:-1] for c in columns], axis=0) if len(table) > 1 else np.zeros(0, dtype=bool)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(table)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = tuple(c[a] for c in columns)
            if held and own != last:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(table.slice(a, b - a))
            last = own
    if held:
        yield pa.concat_tables(held).combine_chunks()


def dealt(members: DataFrame, bucket: list[str], cluster: str, node: str, block: int) -> DataFrame:
    """Deal the members of buckets into pairs of blocks (low, high), so that every two members of
    different clusters meet once; with ``side``, the block that a row stands for.

    Members of a bucket's largest cluster need not meet each other: they go to the blocks of the
    others alone, one each where those fill one block. So a bucket that is nearly one cluster costs
    about a row a member, however large it is.
    """
    sizes = members.groupBy(*bucket, cluster).agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy(*bucket).agg(F.max(F.struct("n", cluster)).alias("main"), F.sum("n").alias("m"))
    main = main.select(*bucket, F.col(f"main.{cluster}").alias("main"), F.ceil(F.col("main.n") / block).alias("wide"), F.ceil((F.col("m") - F.col("main.n")) / block).alias("narrow"))
    rows = members.join(main, bucket).withColumn("common", F.col(cluster) == F.col("main"))
    side = F.when(F.col("common"), F.col("narrow") + F.pmod(F.xxhash64(node), "wide")).otherwise(F.pmod(F.xxhash64(node), "narrow"))
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("common"), F.col("narrow")).otherwise(F.col("narrow") + F.col("wide")) - 1)
    rows = rows.withColumn("side", side).withColumn("other", F.explode(others))
    return rows.withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other")).drop("main", "wide", "narrow", "common", "other")
