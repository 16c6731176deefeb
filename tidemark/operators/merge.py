"""Merging without MERGE: inserts, upserts, replacements and key registries as plain joins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.lease import Lease


def new_rows(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose key is new, one for each key."""
    return batch.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def insert_ignore(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    return existing.unionByName(new_rows(existing, batch, keys))


def upsert(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch replaces rows of the same key."""
    return existing.join(batch.select(*keys), keys, "left_anti").unionByName(batch)


def replace_groups(existing: DataFrame, batch: DataFrame, group: str) -> DataFrame:
    """Rows of every group in the batch are replaced by the batch's."""
    return existing.join(batch.select(group).distinct(), group, "left_anti").unionByName(batch)


def drop_orphans(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    return children.join(parents.select(*keys), keys, "left_semi")


def register_keys(registry: DataFrame, members: DataFrame, business: str, key: str) -> DataFrame:
    """The registry with keys for members it lacks, after its largest; known keys never change.

    New members are numbered within buckets of their hash, each starting after the buckets before
    it, so that no task sorts them all.
    """
    last = registry.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    fresh = members.select(business).filter(F.col(business).isNotNull()).distinct().join(registry.select(business), business, "left_anti")
    fresh = fresh.withColumn("__b", F.pmod(F.xxhash64(business), F.lit(256)))
    before = Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = fresh.groupBy("__b").agg(F.count(F.lit(1)).alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))  # 256 rows
    nth = F.row_number().over(Window.partitionBy("__b").orderBy(business))
    numbered = fresh.withColumn("__nth", nth).join(starts, "__b").select(business, (F.col("__start") + F.col("__nth") + F.lit(max(last, 0))).cast(registry.schema[key].dataType).alias(key))
    return registry.select(business, key).unionByName(numbered)


POINTER = "version string, published_at timestamp, fence long"


def publish(tables: dict[str, DataFrame], root: str, lease: Lease | None = None, write: Callable[[str, DataFrame, str], None] | None = None) -> str:
    """Write all tables to a new version and then point to it: readers see all of it or nothing.

    With a lease the pointer carries its fence, and is written only while the lease holds; a writer
    that was overtaken raises LeaseLost and leaves readers where they are. ``write`` (name, table, path)
    writes a table in its own way.
    """
    version = f"v={uuid.uuid4().hex}"
    spark = next(iter(tables.values())).sparkSession
    for name, table in tables.items():
        path = f"{root}/{version}/{name}"
        if write is None:
            table.write.parquet(path)
        else:
            write(name, table, path)
    if lease is not None:
        lease.check()
    order = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"), F.lit(0 if lease is None else lease.fence).cast("long").alias("fence"))
    order.write.mode("append").parquet(f"{root}/_current")
    return version


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version published last under the highest fence, null before the first."""
    try:
        pointers = spark.read.schema(POINTER).parquet(f"{root}/_current")
        row = pointers.agg(F.max_by("version", F.struct(F.coalesce("fence", F.lit(0)), "published_at"))).first()
    except AnalysisException:
        return None
    return row[0]


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return spark.read.parquet(f"{root}/{version}/{name}")
