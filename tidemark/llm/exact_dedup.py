"""Operator 3: exact deduplication by skew-safe combining, in DataFrame operations only.

Texts are equal when identical after lower-casing A-Z. Three combining stages, each grouping by
digest *and* full content, so that two texts with one digest never meet:

1. local: the map side of the first aggregation keeps one row per text and input partition;
2. salted: digest groups merge under a salt, so a text that fills a third of the corpus is
   spread over ``salts`` reducers;
3. global: the salt winners (at most ``salts`` a text) merge.

Winners of two rows or more go to the shared folder without their texts, and rows find theirs by
digest; all others are alone. That is exact as long as no digest has two texts; this is checked,
and otherwise rows are joined by digest and content. Few winners are broadcast, so that the many
rows of one text stay where they are; more are joined by a shuffle, which adaptive execution splits
where one text has many rows.

Defined cases: a null text counts as empty; a null id ranks below every other; where all ids of a
group are null, keep_id is null and the rows count as kept; rows that repeat the winner's id all
count as kept in the report, while ``exact_dedup`` returns one of them. Extra columns are ignored
by the report and returned untouched by ``exact_dedup``, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._tables import mark_of, materialise, one_of_each, unused, without


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the fast built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def _keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    norm = ascii_lower(F.coalesce(df[text], F.lit("")))
    return df.select(df[key].alias("doc_id"), norm.alias("norm")).withColumn("text_sha256", F.sha2("norm", 256))


def winners(keyed: DataFrame, salts: int) -> DataFrame:
    """One row per distinct text: its digest, the largest id and the number of rows."""
    salted = keyed.withColumn("salt", F.spark_partition_id() % salts)
    merged = salted.groupBy("text_sha256", "salt", "norm").agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))
    return merged.groupBy("text_sha256", "norm").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))


def _reported(keyed: DataFrame, salts: int, most_broadcast: int) -> DataFrame:
    """``keyed`` with keep_id, group_size and kept."""
    found = winners(keyed, salts).filter("group_size > 1")
    groups = materialise(found.select("text_sha256", "keep_id", "group_size"), "exact-winners")
    on = ["text_sha256"]
    if not groups.groupBy("text_sha256").count().filter("count > 1").isEmpty():
        groups, on = found, ["text_sha256", "norm"]
    elif groups.count() <= most_broadcast:
        groups = F.broadcast(groups)
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return keyed.join(groups, on, "left").select(
        *[c for c in keyed.columns if c != "text_sha256"], keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), (alone | F.col("doc_id").eqNullSafe(keep)).alias("kept"), "text_sha256"
    )


def exact_dedup_report(df: DataFrame, key: str = "doc_id", text: str = "text", salts: int = 16, most_broadcast: int = 250_000) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    return _reported(_keyed(df, key, text), salts, most_broadcast).drop("norm")


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", salts: int = 16, most_broadcast: int = 250_000) -> DataFrame:
    """The rows of ``df`` that stay, one of each text, with all their columns. Rows are told apart
    by id and text together, so ids may be null or repeated."""
    mark = unused(df, "mark")
    of = mark_of(df[key], ascii_lower(F.coalesce(df[text], F.lit(""))))
    report = _reported(_keyed(df, key, text), salts, most_broadcast)
    report = materialise(report.select(mark_of(F.col("doc_id"), F.col("norm")).alias(mark), "kept", "group_size"), "exact-report")
    stays = without(df.withColumn(mark, of), report.filter(~F.col("kept")), mark, most_broadcast)
    repeated = report.filter("kept AND group_size > 1").groupBy(mark).count().filter("count > 1")
    return one_of_each(stays, repeated, mark).select(*df.columns)
