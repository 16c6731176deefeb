"""Tables that are loaded in increments: partitioned, bucketed on their key, rewritten only where a
batch touches them.

A batch is matched with the partitions it has rows for. Their files are bucketed on the key, so the
old side of the match is read in place and only the batch is shuffled, to the same buckets. The
touched partitions are then replaced by dynamic overwrite; all others stay as they are, file by file.
One writer at a time: take a lease first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class KeyedTable:
    """A table of the catalog. ``partition`` is one of its keys, or a column that the keys determine:
    rows of one key never lie in two partitions."""

    spark: SparkSession
    name: str
    keys: tuple[str, ...]
    partition: str
    buckets: int

    @classmethod
    def create(cls, spark: SparkSession, name: str, like: DataFrame, keys: list[str], partition: str, location: str, buckets: int = 200) -> KeyedTable:
        """The table at a location, made there if there is none yet."""
        own = [c for c in keys if c != partition]
        columns = ", ".join(f"`{c}` {kind}" for c, kind in like.dtypes)
        listed = ", ".join(f"`{c}`" for c in own)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (`{partition}`) CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS LOCATION '{location}'")
        return cls(spark, name, tuple(keys), partition, buckets)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def touched(self, batch: DataFrame) -> DataFrame:
        """The rows of the partitions that the batch has rows for. Their names are directories."""
        values = [r[0] for r in batch.select(self.partition).distinct().collect()]
        here = F.col(self.partition).isin([v for v in values if v is not None])
        return self.read().filter(here | F.col(self.partition).isNull() if None in values else here)

    def _dealt(self, batch: DataFrame) -> DataFrame:
        """The batch in the table's columns and buckets, so that it fills few files."""
        return batch.select(*self.read().columns).repartition(self.buckets, *[c for c in self.keys if c != self.partition])

    def _matched(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Rows of ``left`` without a partner in ``right``, joined in the table's buckets.

        Partitions are compared as a range: an equality would become a key of the join, and files that
        are bucketed on the other keys alone would no longer be dealt as the join wants them.
        """
        l, r = left.alias("l"), right.select(*self.keys).distinct().alias("r")
        at = lambda side: F.col(f"{side}.{self.partition}")
        on = (at("l") <= at("r")) & (at("l") >= at("r"))
        for c in self.keys:
            if c != self.partition:
                on = on & (F.col(f"l.{c}") == F.col(f"r.{c}"))
        return l.join(r, on, "left_anti")

    def merged(self, batch: DataFrame) -> DataFrame:
        """What the touched partitions hold once the batch has replaced rows of the same key. Keys are
        not null, and the batch has each once."""
        return self._matched(self.touched(batch), batch).select(*self.read().columns).unionByName(self._dealt(batch))

    def upsert(self, batch: DataFrame) -> None:
        self._overwrite(self.merged(batch))

    def fresh(self, batch: DataFrame) -> DataFrame:
        """One row for each key of the batch that the table lacks."""
        return self._matched(batch.dropDuplicates(list(self.keys)), self.touched(batch))

    def insert_ignore(self, batch: DataFrame) -> None:
        """Add what is new; nothing is rewritten."""
        self._dealt(self.fresh(batch)).write.insertInto(self.name)

    def replace_partitions(self, batch: DataFrame) -> None:
        """The batch is all there is in each partition that it has rows for."""
        self._overwrite(self._dealt(batch))

    def _overwrite(self, rows: DataFrame) -> None:
        conf, mode = self.spark.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(mode)
        conf.set(mode, "dynamic")  # as an option of the write it comes too late for a table that is read too
        try:
            rows.write.insertInto(self.name, overwrite=True)
        finally:
            conf.set(mode, before)
