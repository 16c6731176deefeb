"""The daily run: read sources, load, gate, clean, gate, build, check, log, alert.

Everything relational is a DataFrame; this module only decides what runs. State lives in a
``Lake``: append-only raw tables, and clean and warehouse tables published as whole versions, so a
failed gate leaves readers with the version before.
"""

from __future__ import annotations

import hashlib
import json
import logging
import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.operators import merge, versions
from tidemark.operators.lease import held
from tidemark.plans import clean, quality, views, warehouse
from tidemark.shared import kept
from tidemark.sources import policy, raw_layer

log = logging.getLogger(__name__)

#: Credentials that sources need, the sources of a run, hours between API runs.
CREDENTIALS = {"reliefweb": "RELIEFWEB_APPNAME", "jsearch": "JSEARCH_API_KEY", "jooble": "JOOBLE_API_KEY"}
HOURS_BETWEEN = {"jsearch": 20, "jooble": 12}
SILENCE_HOURS = {"error": 12, "warn": 72}


class RunFailed(RuntimeError):
    """A run ended with errors."""


@dataclass
class Lake:
    """Where the tables of one deployment lie."""

    spark: SparkSession
    root: str

    def read(self, name: str, schema: str) -> DataFrame:
        """An append-only table, empty before its first row."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.root}/{name}")

    def raw(self) -> DataFrame:
        return self.read("raw_postings", schemas.RAW)

    def sightings(self) -> DataFrame:
        """The log folded to a row for each posting and day; it is written as it comes."""
        log_ = self.read("raw_sightings", schemas.SIGHTING)
        return log_.groupBy("source", "job_key", "seen_on").agg(F.bool_or("fetched").alias("fetched"))

    def published(self, layer: str, name: str) -> DataFrame | None:
        path = f"{self.root}/{layer}"
        return None if merge.current_version(self.spark, path) is None else merge.read_current(self.spark, path, name)


def configured_sources(wanted: list[str], environment=None) -> tuple[list[str], dict[str, str]]:
    """Sources that can run, and why the others cannot: a missing credential is no outage."""
    environment = os.environ if environment is None else environment
    missing = {s: f"{CREDENTIALS[s]} is not set" for s in wanted if s in CREDENTIALS and not environment.get(CREDENTIALS[s])}
    return [s for s in wanted if s not in missing], missing


def with_retries(call: Callable[[], dict], waits: list[float], final: tuple[type[Exception], ...] = (), sleep=time.sleep) -> dict:
    """Call again after each wait while it fails; errors in ``final`` are not retried."""
    for wait in [*waits, None]:
        try:
            return call()
        except final:
            raise
        except Exception:
            if wait is None:
                raise
            sleep(wait)
    raise AssertionError("unreachable")


def ingest(lake: Lake, source: str, payloads: DataFrame, now: datetime, raw_files: str | None = None) -> dict:
    """Load one visit of a source: raw files, new versions, the ingest log and sightings."""
    run_id = raw_layer.new_run_id(now)
    batch = raw_layer.wrap(payloads, source, run_id, now)
    if raw_files is not None:
        raw_layer.write_batch(batch, raw_files)
    counts = _load(lake, batch, now)
    day = F.lit(now.astimezone(timezone(timedelta(hours=3))).date())
    lake.append("raw_sightings", batch.select("source", "job_key", day.alias("seen_on"), F.lit(True).alias("fetched")).distinct())
    return {"source": source, "status": "ok" if counts else "empty", "seen": sum(r["seen"] for r in counts), "inserted": sum(r["inserted"] for r in counts)}


def _load(lake: Lake, batch: DataFrame, now: datetime) -> list:
    """Add the versions of a batch that the raw table lacks; what was seen and added by source and run."""
    fresh, logged = raw_layer.load_envelopes(lake.raw(), batch, now)
    known = lake.raw().agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    numbered = fresh.select((F.lit(known) + 1 + F.monotonically_increasing_id()).alias("id"), *fresh.columns)
    counts = logged.collect()  # a row for each source and run
    lake.append("raw_postings", numbered.select(*StructType.fromDDL(schemas.RAW).names))
    lake.append("ingest_log", lake.spark.createDataFrame(counts, schemas.INGEST_LOG))
    return counts


def replay(lake: Lake, raw_files: str, now: datetime, source: str | None = None, since: str | None = None, until: str | None = None) -> dict[str, dict[str, int]]:
    """Load raw files once more, of one source or a range of days (both ends included) if given: the
    raw table is what its files make it. Only the partitions asked for are read. Versions that are
    there stay, so a second replay adds nothing; sightings are seeded by the days of scraping. The
    counts by source."""
    batch = kept(raw_layer.read_batches(lake.spark, raw_files, source, since, until), "replayed")
    if batch.isEmpty():
        return {}
    told: dict[str, dict[str, int]] = {}
    for r in _load(lake, batch, now):
        of = told.setdefault(r["source"], {"seen": 0, "inserted": 0})
        of["seen"] += r["seen"]
        of["inserted"] += r["inserted"]
    known = lake.read("raw_sightings", schemas.SIGHTING)
    seeded = versions.seed_sightings(known.limit(0), batch).join(known, ["source", "job_key", "seen_on"], "left_anti")
    lake.append("raw_sightings", seeded.select("source", "job_key", "seen_on", "fetched"))
    return told


def run_source(lake: Lake, source: str, fetch: Callable[[SparkSession, DataFrame], DataFrame], now: datetime, refresh_days: int = 14, policies=policy.POLICIES, environment=None) -> dict:
    """One incremental visit: refused by policy, busy in another run, throttled, or fetched and
    loaded. ``fetch`` gets the keys that are fresh and need no visit, and returns a DataFrame with a ``payload`` variant."""
    policy.require(source, policies, environment)
    with held(lake.spark, f"{lake.root}/_sources/{source}", f"run of {source}") as own:
        if own is None:
            return {"source": source, "status": "busy", "seen": 0, "inserted": 0}
        return _visit(lake, source, fetch, now, refresh_days)


def _visit(lake: Lake, source: str, fetch: Callable[[SparkSession, DataFrame], DataFrame], now: datetime, refresh_days: int) -> dict:
    hours = raw_layer.hours_since_last_load(lake.read("ingest_log", schemas.INGEST_LOG), source, now)
    if hours is not None and hours < HOURS_BETWEEN.get(source, 0):
        return {"source": source, "status": "throttled", "hours": round(hours, 1)}
    fresh = versions.fresh_keys(lake.sightings(), source, F.lit(now.date()), refresh_days)
    payloads = fetch(lake.spark, fresh)
    if payloads.isEmpty():
        return {"source": source, "status": "empty"}
    return ingest(lake, source, payloads, now)


#: Names of published tables in checks.
CHECKED = {
    "clean": {"job_postings": "clean.job_postings", "job_skills": "clean.job_skills"},
    "dw": {"fact": "dw.fact_job_postings", "bridge": "dw.bridge_job_skill", "dim_company": "dw.dim_company", "dim_location": "dw.dim_location", "dim_date": "dw.dim_date", "dim_skill": "dw.dim_skill"},
}


def _publish(lake: Lake, layer: str, tables: dict[str, DataFrame], watch: quality.Watch | None) -> None:
    """Publish under the layer's lease, its checks measured as the tables are written."""
    write = None if watch is None else lambda name, df, path: watch.write(CHECKED[layer].get(name, name), df, path)
    with held(lake.spark, f"{lake.root}/{layer}", f"{layer} build") as own:
        if own is None:
            raise RunFailed(f"another run is publishing {layer}")
        merge.publish(tables, f"{lake.root}/{layer}", own, write)


def build_clean(lake: Lake, watch: quality.Watch | None = None) -> int:
    """Publish clean postings and skills rebuilt from raw; returns how many postings."""
    postings, skills = clean.build(lake.raw(), lake.sightings())
    _publish(lake, "clean", {"job_postings": postings, "job_skills": skills}, watch)
    return lake.published("clean", "job_postings").count()


def build_warehouse(lake: Lake, watch: quality.Watch | None = None) -> dict[str, int]:
    """Publish the star schema. Key registries of the last build carry over."""
    last = {name: lake.published("dw", name) for name in ("company_keys", "skill_keys", "posting_keys")}
    empty = warehouse.empty_registries(lake.spark)
    registries = {name: found if found is not None else empty[name] for name, found in last.items()}
    tables = warehouse.build(lake.published("clean", "job_postings"), lake.published("clean", "job_skills"), registries)
    _publish(lake, "dw", tables, watch)
    return {name: lake.published("dw", name).count() for name in ("fact", "dim_company", "dim_skill", "bridge")}


def view_tables(lake: Lake) -> dict[str, DataFrame]:
    names = ("fact", "bridge", "dim_date", "dim_location", "dim_company", "dim_skill")
    return {n: lake.published("dw", n) for n in names} | {"publishing": policy.publishing_table(lake.spark), "sightings": lake.sightings()}


def check_tables(lake: Lake) -> dict[str, DataFrame]:
    tables = {"raw.job_postings": lake.raw(), "raw.sightings": lake.sightings()}
    for layer, names in CHECKED.items():
        for name, key in names.items():
            found = lake.published(layer, name)
            if found is not None:
                tables[key] = found
    if "dw.fact_job_postings" in tables:
        tables["dw.v_public_jobs"] = views.public_jobs(view_tables(lake))
    return tables


@dataclass
class Summary:
    outcomes: dict[str, dict] = field(default_factory=dict)
    notes: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    quality: dict[str, dict] = field(default_factory=dict)
    clean_rows: int | None = None
    warehouse: dict[str, int] | None = None

    def status(self) -> str:
        return "failed" if self.errors else "warnings" if self.warnings else "ok"


def alert(lake: Lake, level: str, subject: str, body: str, now: datetime, send: Callable[[str, str, str], list[str]], same: str) -> dict:
    """Send an alert unless the same one was sent within its silence. Never raises."""
    mark = hashlib.sha1(same.encode()).hexdigest()[:16]
    try:
        since = now - timedelta(hours=SILENCE_HOURS.get(level, 12))
        recent = lake.read("alerts", schemas.ALERT).filter((F.col("fingerprint") == mark) & (F.col("sent_at") > F.lit(since)))
        if not recent.isEmpty():
            return {"skipped": "duplicate"}
        channels = send(level, subject, body)
        if channels:
            lake.append("alerts", lake.spark.createDataFrame([(mark, level, subject, ",".join(channels), now)], schemas.ALERT))
        return {"sent": channels}
    except Exception:
        log.exception("an alert could not be sent")
        return {"sent": []}


def run_daily(
    lake: Lake, sources: dict[str, Callable[[SparkSession, DataFrame], DataFrame]], now: datetime, as_of: date | None = None, send=lambda level, subject, body: [], waits=(60.0, 300.0), environment=None, sleep=time.sleep,
) -> Summary:
    """One run. Raw errors stop everything behind them, clean errors keep the warehouse as it was;
    the operational checks always run. Raises RunFailed if there were errors, once all is logged."""
    as_of = as_of or now.date()
    summary, started = Summary(), now
    checks = quality.all_checks(as_of, list(policy.POLICIES))
    watch = quality.Watch(checks)

    def gate(layer: str) -> bool:
        results = quality.run_checks(checks, check_tables(lake), layer, known=watch.measures)
        if results:
            lake.append("dq_results", quality.results_frame(lake.spark, results, now))
        told = summary.quality[layer] = quality.summarize(results)
        summary.errors += [f"data quality [{x}]" for x in told["errors"]]
        summary.warnings += [f"data quality [{x}]" for x in told["warnings"]]
        return not told["errors"]

    def finish(status: str) -> None:
        took = (started, datetime.now(timezone.utc))
        told = json.dumps({"errors": summary.errors, "warnings": summary.warnings, "notes": summary.notes, "outcomes": summary.outcomes, "clean_rows": summary.clean_rows, "warehouse": summary.warehouse}, default=str)
        last = lake.read("runs", schemas.RUN).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        lake.append("runs", lake.spark.createDataFrame([(last + 1, *took, status, told)], schemas.RUN))
        problems = summary.errors or summary.warnings
        if problems:
            level = "error" if summary.errors else "warn"
            alert(lake, level, f"pipeline {status}", "\n".join(f"- {x}" for x in [*summary.errors, *summary.warnings]), now, send, "|".join(sorted(problems)))

    try:
        ready, skipped = configured_sources(list(sources), environment)
        summary.notes += [f"skipped {s}: {why}" for s, why in skipped.items()]
        for source in ready:
            try:
                visit = lambda s=source: run_source(lake, s, sources[s], now, environment=environment)
                outcome = with_retries(visit, list(waits), (policy.SourceRefused,), sleep)
            except policy.SourceRefused as why:
                outcome = {"source": source, "status": "refused", "reason": str(why)}
            except Exception as why:  # one source that is down does not stop the others
                outcome = {"source": source, "status": "failed", "reason": f"{type(why).__name__}: {why}"}
            summary.outcomes[source] = outcome
            if outcome["status"] == "failed":
                summary.errors.append(f"source {source} failed: {outcome['reason']}")
            elif outcome["status"] == "empty":
                summary.warnings.append(f"source {source} returned nothing")
            elif outcome["status"] in ("refused", "throttled", "busy"):
                summary.notes.append(f"{source}: {outcome['status']}")
        if not gate("raw"):
            summary.errors.append("clean and warehouse were left as they are: the raw layer failed its checks")
        else:
            summary.clean_rows = build_clean(lake, watch)
            if not gate("clean"):
                summary.errors.append("the warehouse was left as it is: the clean layer failed its checks")
            else:
                summary.warehouse = build_warehouse(lake, watch)
                gate("dw")
        gate("ops")
    except Exception as why:
        summary.errors.append(f"pipeline crashed: {type(why).__name__}: {why}")
        finish("crashed")
        raise
    finish(summary.status())
    if summary.errors:
        raise RunFailed("; ".join(summary.errors))
    return summary


def health(lake: Lake) -> dict:
    """Ages and failing checks for the operations page."""
    runs = lake.read("runs", schemas.RUN)
    row = runs.agg(F.max("finished_at").alias("last"), F.max(F.when(F.col("status").isin("ok", "warnings"), F.col("finished_at"))).alias("last_ok")).first()
    failing = views.latest_dq(lake.read("dq_results", schemas.DQ_RESULT)).filter("NOT passed").select("check_name", "severity", "detail")
    return {"last_run": row["last"], "last_good_run": row["last_ok"], "failing": failing}
