"""Reading inputs and cutting lineage, shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir, which a cluster has to name.

    Where driver and executors are one process (tests) a temporary folder stands in.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/tidemark-shared"
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it reread: later plans start there,
    and a lost executor costs a reread instead of the whole lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mark_of(key: Column, text: Column) -> Column:
    """A digest of a row's id and text. Rows with one mark are copies of each other in both, so it
    does not matter which of them stays."""
    part = lambda letter, x: F.when(x.isNull(), F.lit("-")).otherwise(F.concat(F.lit(letter), x.cast("string")))
    return F.md5(F.concat_ws("\0", part("k", key), part("t", text)))


def without(df: DataFrame, gone: DataFrame, on: str, most_broadcast: int = 250_000) -> DataFrame:
    """The rows of ``df`` whose column ``on``, never null, is not in ``gone``. At most
    ``most_broadcast`` values are broadcast, so that the rows stay where they are; more are joined
    by a shuffle."""
    gone = materialise(gone.select(on).distinct(), "gone")
    if gone.count() <= most_broadcast:
        gone = F.broadcast(gone)
    return df.join(gone, on, "left_anti")


def one_of_each(df: DataFrame, repeated: DataFrame, on: str) -> DataFrame:
    """One row for each value of ``on`` that is in ``repeated``, and all rows with other values."""
    repeated = materialise(repeated.select(on).distinct(), "repeated")
    if repeated.isEmpty():
        return df
    return df.join(repeated, on, "left_anti").unionByName(df.join(repeated, on, "left_semi").dropDuplicates([on]))


def pieces(n_bytes: int, piece: int) -> int:
    """How many pieces of about ``piece`` bytes hold ``n_bytes``, one at least."""
    return max(1, -(-n_bytes // piece))
