"""Incremental ingest of raw files as a stream: new files only, each version once, for good.

The load of the daily run, for files that keep arriving.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import dates
from tidemark.operators import merge

FILES = "job_key string, content_hash string, scraped_at timestamp, run_id string, payload string, source string, dt date"
VERSION = ["source", "job_key", "content_hash"]
LOADED = f"{FILES}, batch long"
LEDGER = "seen long, inserted long, source string, batch long"


def read_raw_stream(spark: SparkSession, root: str) -> DataFrame:
    """Envelopes of files as they come."""
    return spark.readStream.schema(FILES).json(f"{root}/raw")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """Every version that the stream has loaded."""
    return _read(spark, f"{target}/rows", LOADED)


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """What each batch saw and added, by source."""
    return _read(spark, f"{target}/ledger", LEDGER)


def load_batch(batch: DataFrame, number: int, target: str) -> None:
    """Add the versions of a micro-batch that no other batch has, and enter it in the ledger.

    The batch owns the directories of its number and replaces them whole, and what it compares itself
    with leaves them out. So a batch that is run again, whether it died before its rows, after them
    or after its entry, leaves what one run would have left. A version that returns after a year is
    no new one: nothing is forgotten, and no state grows.
    """
    spark = batch.sparkSession
    others = loaded(spark, target).filter(F.col("batch") != number)
    fresh = merge.new_rows(others, batch, VERSION)
    fresh.write.mode("overwrite").parquet(f"{target}/rows/batch={number}")
    added = spark.read.schema(FILES).parquet(f"{target}/rows/batch={number}").groupBy("source").agg(F.count(F.lit(1)).alias("inserted"))
    seen = batch.groupBy("source").agg(F.count(F.lit(1)).alias("seen"))
    counted = seen.join(added, "source", "left").select("seen", F.coalesce("inserted", F.lit(0)).cast("long").alias("inserted"), "source")
    counted.write.mode("overwrite").parquet(f"{target}/ledger/batch={number}")


def load_available(spark: SparkSession, root: str, target: str, checkpoint: str) -> StreamingQuery:
    """Load everything that is new since the last call, then stop. Use one checkpoint for a target."""
    return read_raw_stream(spark, root).writeStream.foreachBatch(lambda batch, number: load_batch(batch, number, target)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def weekly_arrivals(rows: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Distinct postings per source and week of their scraping, each week emitted once it is complete.
    Windows begin on Mondays: the epoch's week began on a Thursday, four days before one. State holds
    the postings of open weeks only."""
    week = F.window("scraped_at", "7 days", "7 days", "4 days").alias("w")
    once = rows.withWatermark("scraped_at", lateness).select("source", "job_key", week).dropDuplicates(["w", "source", "job_key"])
    return once.groupBy("w", "source").agg(F.count(F.lit(1)).alias("postings")).select(F.col("w.start").cast("date").alias("week_start"), "source", "postings")


def daily_sightings(rows: DataFrame, lateness: str = "2 days") -> DataFrame:
    """One row per posting and local day it was read on."""
    days = rows.withColumn("seen_on", dates.local_date(F.col("scraped_at"))).withWatermark("scraped_at", lateness)
    return days.dropDuplicatesWithinWatermark(["source", "job_key", "seen_on"]).select("source", "job_key", "seen_on", F.lit(True).alias("fetched"))
