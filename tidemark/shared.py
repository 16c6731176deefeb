"""Cutting a plan: intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which a cluster has to name; where driver and executors are one process
    a temporary folder stands in."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"file://{tempfile.gettempdir()}/tidemark-shared"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and reread, for plans that read it several times: later plans start from
    the files, and so does the repair after a lost executor."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least three partitions a core, for steps whose work on a row outweighs its bytes:
    a small file alone is one task."""
    least = 3 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` by keys in as many partitions as the session shuffles into, for large joins that sort.
    Left to itself, adaptive execution merges them down to one a core, and a task's sort grows with that."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism), *keys)
