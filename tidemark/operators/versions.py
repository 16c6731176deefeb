"""Versions, sightings and duplicates of postings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates


def latest_version(versions: DataFrame, keys: list[str], order: list[str], wanted: list[str] | None = None) -> DataFrame:
    """Of each key the row with the largest ``order``, a null being least. ``order`` tells the rows of
    a key apart.

    Only keys and order are grouped, and combined before the shuffle. If ``wanted`` (else all
    columns) has more than those, the rows that win are joined back.
    """
    wanted = versions.columns if wanted is None else wanted
    newest = versions.groupBy(*keys).agg(F.max(F.struct(*order)).alias("__newest"))
    if set(wanted) <= {*keys, *order}:
        return newest.select(*[c if c in keys else F.col(f"__newest.{c}") for c in wanted])
    same = [versions[c].eqNullSafe(newest[c]) for c in keys] + [versions[c].eqNullSafe(F.col(f"__newest.{c}")) for c in order]
    return versions.join(newest, reduce(Column.__and__, same)).select(*[versions[c] for c in wanted])


def first_last_seen(raw: DataFrame, sightings: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """The latest version of each posting with its first and last sighting: noon of the local day
    where the sightings log has it, else the times it was scraped."""
    keys = ["source", "job_key"]
    if sources is not None:
        raw = raw.filter(F.col("source").isin(sources))
    seen = sightings.groupBy(*keys).agg(F.min("seen_on").alias("first_on"), F.max("seen_on").alias("last_on"))
    place = F.struct("scraped_at", "id")
    spans = raw.groupBy(*keys).agg(F.max(place).alias("newest"), F.min("scraped_at").alias("first_scraped"), F.max("scraped_at").alias("last_scraped"))
    spans = spans.join(seen, keys, "left").select(
        *[spans[c].alias(f"of_{c}") for c in keys], "newest",
        F.coalesce(dates.local_noon(F.col("first_on")), F.col("first_scraped")).alias("first_seen"),
        F.coalesce(dates.local_noon(F.col("last_on")), F.col("last_scraped")).alias("last_seen"),
    )
    won = raw["source"].eqNullSafe(F.col("of_source")) & raw["job_key"].eqNullSafe(F.col("of_job_key")) & raw["id"].eqNullSafe(F.col("newest.id")) & raw["scraped_at"].eqNullSafe(F.col("newest.scraped_at"))
    return raw.join(spans, won).select(*[raw[c] for c in raw.columns], "first_seen", "last_seen")


def record_sightings(log: DataFrame, seen: DataFrame) -> DataFrame:
    """The log with new sightings; a posting that was fetched once on a day stays fetched."""
    keys = ["source", "job_key", "seen_on"]
    return log.unionByName(seen).groupBy(*keys).agg(F.bool_or("fetched").alias("fetched"))


def seed_sightings(log: DataFrame, raw: DataFrame) -> DataFrame:
    """Each raw version was seen and fetched on the local day it was scraped."""
    rows = raw.select("source", "job_key", dates.local_date(F.col("scraped_at")).alias("seen_on"), F.lit(True).alias("fetched")).distinct()
    return log.unionByName(rows.join(log, ["source", "job_key", "seen_on"], "left_anti"))


def fresh_keys(log: DataFrame, source: str, as_of: Column, days: int) -> DataFrame:
    """Postings fetched on the day ``as_of``, the ``days`` days before it or later."""
    recent = (F.col("source") == source) & F.col("fetched") & (F.col("seen_on") >= F.date_sub(as_of, days))
    return log.filter(recent).select("job_key").distinct()


def flag_duplicates(postings: DataFrame) -> DataFrame:
    """is_duplicate and the canonical posting of each: the earliest posted of equal dedup keys.
    The first of each key is an aggregate that combines before the shuffle, so a key that many
    postings share gathers them nowhere. Postings without a key form no group."""
    date, seen = F.col("date_posted"), F.col("first_seen_at")
    order = F.struct(date.isNull().alias("a"), date.alias("b"), seen.isNull().alias("c"), seen.alias("d"), F.col("source").alias("s"), F.col("job_key").alias("k"))
    firsts = postings.filter(F.col("dedup_key").isNotNull()).groupBy(F.col("dedup_key").alias("of")).agg(F.min(order).alias("first"))
    joined = postings.join(firsts, F.col("dedup_key") == F.col("of"), "left")
    twin = F.col("first").isNotNull() & ~(F.col("source").eqNullSafe(F.col("first.s")) & F.col("job_key").eqNullSafe(F.col("first.k")))
    return joined.select(*[postings[c] for c in postings.columns], twin.alias("is_duplicate"), F.when(twin, F.col("first.s")).alias("canonical_source"), F.when(twin, F.col("first.k")).alias("canonical_job_key"))
