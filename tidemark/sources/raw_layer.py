"""The raw layer: immutable gzip JSON files by source and day, and the versioned raw table."""

from __future__ import annotations

import gzip
import uuid
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import merge

#: Fields that may name a posting, in order, and top-level fields that change on every visit.
KEY_FIELDS = ["url", "job_url", "source_url", "link", "id", "job_id", "identifier"]
VOLATILE_FIELDS = ["fetched_at", "scraped_at", "observed"]
#: Fields that wrap a list of records in a file.
WRAPPERS = ["jobs", "records", "items", "data", "results"]


def text_at(payload: Column, path: str) -> Column:
    """A field as text, null if missing, empty or no scalar."""
    return F.nullif(F.trim(F.try_variant_get(payload, path, "string")), F.lit(""))


def stable_json(payload: Column) -> Column:
    """The payload as JSON with sorted keys, without its volatile top-level fields."""
    fields = F.try_variant_get(payload, "$", "map<string,variant>")
    kept = F.map_filter(fields, lambda k, v: ~k.isin(VOLATILE_FIELDS))
    entries = F.array_sort(F.transform(F.map_entries(kept), lambda e: F.struct(e["key"].alias("k"), F.to_json(e["value"]).alias("v"))))
    return F.to_json(entries)


def content_hash(payload: Column) -> Column:
    return F.sha2(stable_json(payload), 256)


def job_key(payload: Column) -> Column:
    """The first field that names the posting, else the first half of its content hash."""
    named = []
    for field in KEY_FIELDS:
        inner = F.coalesce(text_at(payload, f"$.{field}.value"), text_at(payload, f"$.{field}['@id']"))
        whole = F.when(F.schema_of_variant(F.try_variant_get(payload, f"$.{field}", "variant")).startswith("OBJECT"), inner).otherwise(text_at(payload, f"$.{field}"))
        named.append(whole)
    return F.coalesce(*named, F.left(content_hash(payload), F.lit(32)))


def new_run_id(at: datetime) -> str:
    return f"{at:%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def wrap(payloads: DataFrame, source: str, run_id: str, scraped_at: datetime, payload: str = "payload") -> DataFrame:
    """Envelopes of one visit: who, which posting, which content, when, and the untouched payload."""
    p = F.col(payload)
    return payloads.select(
        F.lit(source).alias("source"), job_key(p).alias("job_key"), content_hash(p).alias("content_hash"),
        F.lit(scraped_at).cast("timestamp").alias("scraped_at"), F.lit(run_id).alias("run_id"), p.alias("payload"),
    )


def write_batch(envelopes: DataFrame, root: str) -> None:
    """Append one run as gzip JSON lines under source=/dt=. An empty run is an error."""
    if envelopes.isEmpty():
        raise ValueError("no records to write")
    rows = envelopes.select("source", F.date_format("scraped_at", "yyyy-MM-dd").alias("dt"), "job_key", "content_hash", F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("scraped_at"), "run_id", F.to_json("payload").alias("payload"))
    rows.write.mode("append").partitionBy("source", "dt").option("compression", "gzip").json(f"{root}/raw")


def read_batches(spark: SparkSession, root: str, source: str | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """Envelopes of the raw files; source, first and last day prune partitions."""
    schema = "job_key string, content_hash string, scraped_at timestamp, run_id string, payload string, source string, dt date"
    rows = spark.read.schema(schema).json(f"{root}/raw")
    if source is not None:
        rows = rows.filter(F.col("source") == source)
    if since is not None:
        rows = rows.filter(F.col("dt") >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.filter(F.col("dt") <= F.lit(until).cast("date"))
    return rows.select("source", "job_key", "content_hash", "scraped_at", "run_id", F.parse_json("payload").alias("payload"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Payloads of JSON files: a list, an object that wraps one, a single object, or a line each."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\\uFEFF", "").alias("value"))
    parsed = whole.select("value", F.try_parse_json("value").alias("v"))
    kind = F.schema_of_variant("v")
    lists = [F.try_variant_get("v", f"$.{w}", "array<variant>") for w in WRAPPERS]
    records = F.when(kind.startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>")).when(kind.startswith("OBJECT"), F.coalesce(*lists, F.array("v")))
    lines = F.filter(F.split("value", "\r?\n"), lambda x: F.trim(x) != "")
    each = F.transform(lines, lambda x: F.try_parse_json(x))  # the parser reads one value and leaves what follows
    by_line = (F.size(lines) > 1) & F.forall(each, lambda v: v.isNotNull())
    rows = parsed.select(F.explode(F.when(by_line, each).otherwise(records)).alias("payload"))
    return rows.filter(F.schema_of_variant("payload").startswith("OBJECT"))


def load_envelopes(existing: DataFrame, batch: DataFrame, loaded_at: datetime) -> tuple[DataFrame, DataFrame]:
    """New versions to append to the raw table, and the log rows of the load (seen, inserted)."""
    keys = ["source", "job_key", "content_hash"]
    fresh = merge.new_rows(existing, batch, keys)
    seen = batch.groupBy("source", "run_id").agg(F.count(F.lit(1)).alias("seen"))
    added = fresh.groupBy("source", "run_id").agg(F.count(F.lit(1)).alias("inserted"))
    log = seen.join(added, ["source", "run_id"], "left").select("source", "run_id", "seen", F.coalesce("inserted", F.lit(0)).alias("inserted"), F.lit(loaded_at).cast("timestamp").alias("loaded_at"))
    return fresh.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp")), log


def hours_since_last_load(log: DataFrame, source: str, now: datetime) -> float | None:
    last = log.filter(F.col("source") == source).agg(F.max("loaded_at")).first()[0]
    if last is None:
        return None
    return (now - (last if now.tzinfo is None else last.replace(tzinfo=timezone.utc))).total_seconds() / 3600


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Saved pages: source, day, page key (16 hex digits of the URL's SHA-1), path and packed content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html*").load(f"{root}/raw_html")
    part = lambda p: F.regexp_extract("path", p, 1)
    return files.select(part(r"source=([^/]+)/").alias("source"), part(r"dt=([^/]+)/").cast("date").alias("dt"), part(r"/([0-9a-f]{16})\.html").alias("page_key"), "path", "content")


def page_key(url: Column) -> Column:
    return F.left(F.sha1(url), F.lit(16))


def latest_snapshots(snapshots: DataFrame, urls: DataFrame) -> DataFrame:
    """The last saved page of each known URL, with its HTML; of two on one day the one whose path comes
    last. The paths are chosen without the pages, so a page that loses is neither shuffled nor
    unzipped."""
    newest = snapshots.groupBy("source", "page_key").agg(F.max(F.struct("dt", "path")).alias("at"))
    known = urls.select("url", page_key(F.col("url")).alias("page_key"))
    chosen = newest.join(known, "page_key").select("url", F.col("at.path").alias("path"))
    return snapshots.join(chosen, "path").select("url", "source", "dt", "page_key", unzipped("content").alias("html"))


@F.pandas_udf(T.StringType())
def unzipped(content: pd.Series) -> pd.Series:
    return content.map(lambda b: (gzip.decompress(b) if b[:2] == b"\x1f\x8b" else b).decode("utf-8", "replace"), na_action="ignore")
