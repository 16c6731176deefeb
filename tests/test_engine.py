"""The engine from raw payloads to published views."""

import gzip
import hashlib
import json
import time
from datetime import date, datetime, timedelta, timezone

import postings
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidemark import raw_catalog
from tidemark.operators import merge, versions
from tidemark.plans import clean, daily, quality, serving, views
from tidemark.sources import adapters, pages, paging, policy, raw_layer

NOW = datetime(2026, 1, 6, 6, 0, tzinfo=timezone.utc)


def raw_rows(spark, source):
    return raw_layer.wrap(postings.frame(spark, postings.BY_SOURCE[source]), source, "r1", NOW)


def test_content_hash_ignores_order_and_volatile_fields(spark):
    rows = ['{"a": 1, "b": {"y": 2, "x": 1}, "fetched_at": "t1"}', '{"b": {"x": 1, "y": 2}, "a": 1, "fetched_at": "t2", "observed": {}}', '{"a": 2}']
    got = [r[0] for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, j string").orderBy("i").select(raw_layer.content_hash(F.parse_json("j"))).collect()]
    assert got[0] == got[1] != got[2]


def test_job_keys(spark):
    rows = [{"url": " https://a "}, {"identifier": {"value": "v9"}, "x": 1}, {"url": "", "id": 5}, {"x": 1}]
    got = [r[0] for r in postings.frame(spark, rows).select(raw_layer.job_key(F.col("payload"))).collect()]
    assert got[:3] == ["https://a", "v9", "5"] and len(got[3]) == 32


def test_raw_files_round_trip(spark, tmp_path):
    batch = raw_rows(spark, "jsearch")
    raw_layer.write_batch(batch, str(tmp_path))
    back = raw_layer.read_batches(spark, str(tmp_path), source="jsearch", since="2026-01-01")
    assert sorted((r[0], r[1]) for r in back.select("job_key", "content_hash").collect()) == sorted((r[0], r[1]) for r in batch.select("job_key", "content_hash").collect())
    assert raw_layer.read_batches(spark, str(tmp_path), since="2026-01-07").isEmpty()
    with pytest.raises(ValueError):
        raw_layer.write_batch(batch.limit(0), str(tmp_path))


def test_record_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('﻿{"jobs": [{"id": 1}, {"id": 2}]}')
    (tmp_path / "b.jsonl").write_text('{"id": 3}\n\n{"id": 4}\n')
    (tmp_path / "c.json").write_text('[{"id": 5}, 6]')
    (tmp_path / "d.json").write_text('{"id": 7}')
    got = raw_layer.read_records(spark, str(tmp_path)).select(F.try_variant_get("payload", "$.id", "int")).collect()
    assert sorted(r[0] for r in got) == [1, 2, 3, 4, 5, 7]


def test_loading_is_idempotent(spark):
    batch = raw_rows(spark, "myjobmag")
    fresh, log = raw_layer.load_envelopes(batch.limit(0), batch.union(batch), NOW)
    assert fresh.count() == 5 and [(r["seen"], r["inserted"]) for r in log.collect()] == [(10, 5)]
    again, log = raw_layer.load_envelopes(batch, batch, NOW)
    assert again.count() == 0 and log.first()["inserted"] == 0


def test_adapters_read_every_shape(spark):
    def one(source, i=0):
        return adapters.adapt(raw_rows(spark, source)).orderBy("job_key").collect()[i]

    js = adapters.adapt(raw_rows(spark, "jsearch")).filter("title = 'Data Analyst'").first()
    assert js["base_low"] is None and js["company"] == "ACME" and js["skills_text"] == "Python, Excel" and js["date_posted"].startswith("2026-01-05")
    cloudy = adapters.adapt(raw_rows(spark, "jsearch")).filter("company = 'Cloudy'").first()
    assert cloudy["base_currency"] == "USD" and cloudy["location_text"] == "Nakuru, KE" and cloudy["remote_hint"]
    rw = one("reliefweb")
    assert (rw["company"], rw["location_text"], rw["employment_type"]) == ("Aid Org", "Garissa", "Job")
    rm = one("remotive")
    assert rm["remote_hint"] and rm["skills_text"] == "python, django" and rm["salary_text"] == "$60k"
    odd = one("brightermonday")
    assert odd["company"] == "Plain Name" and odd["location_text"] == "outside Kenya" and odd["base_single"] is None
    mj = adapters.adapt(raw_rows(spark, "myjobmag")).filter("title = 'Chef'").first()
    assert mj["location_text"] == "Mombasa" and mj["employment_type"] == "FULL_TIME"


def test_sources_are_adapted_in_one_pass(spark):
    """One scan of the rows, whatever the number of sources, and no window of the plan before it repeated."""
    rows = raw_catalog.posted(spark, SF)
    plan = adapters.adapt(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_fingerprint(spark):
    df = spark.createDataFrame([("A Co", "Cook", "X"), ("a  co", "COOK", "x"), ("", "Cook", "X")], "e string, t string, p string")
    a, b, c = (r[0] for r in df.select(adapters.fingerprint(*map(F.col, "etp"))).collect())
    assert a == b and len(a) == 20 and c is None


def lake_of(spark, tmp_path):
    return daily.Lake(spark, str(tmp_path / "lake"))


def fetchers(payloads=postings.BY_SOURCE):
    return {s: (lambda p: lambda spark, fresh: postings.frame(spark, p))(p) for s, p in payloads.items()}


KEYS = {"RELIEFWEB_APPNAME": "x", "JSEARCH_API_KEY": "x", "CONSENT_BRIGHTERMONDAY": "2026-01-01"}


def test_daily_run(spark, tmp_path):
    lake, sent = lake_of(spark, tmp_path), []
    send = lambda level, subject, body: sent.append((level, subject)) or ["test"]
    summary = daily.run_daily(lake, fetchers(), NOW, send=send, waits=(), environment=KEYS)
    assert summary.clean_rows == 10 and summary.warehouse["fact"] == 10 and not summary.errors
    assert summary.outcomes["jsearch"]["status"] == "ok" and sent and sent[0][0] == "warn"
    posts = lake.published("clean", "job_postings")
    analyst = {r["source"]: r for r in posts.filter("title_norm = 'data analyst'").collect()}
    assert not analyst["myjobmag"]["is_duplicate"] and analyst["jsearch"]["is_duplicate"] and analyst["jsearch"]["canonical_source"] == "myjobmag"
    assert analyst["myjobmag"]["description_text"].endswith("Mail [email]") and analyst["myjobmag"]["county"] == "Nairobi" and analyst["jsearch"]["salary_min"] is None
    dev = posts.filter("title_clean = 'Software Developer'").first()
    assert (dev["salary_source"], int(dev["salary_min_monthly_kes"]), dev["county"]) == ("text", 150000, "Kiambu")
    accountant = posts.filter("title_clean = 'Senior Accountant'").first()
    assert accountant["company_norm"] is None and accountant["dedup_key"] is None and accountant["salary_min"] is None and accountant["seniority"] == "senior"
    t = daily.view_tables(lake)
    shown = {r["title"]: r for r in views.public_jobs(t).collect()}
    assert "Backend Developer" not in shown and "Odd" not in shown and shown["Data Analyst"]["skills"] == ["Power BI", "Python", "SQL"]
    assert shown["Chef"]["category"] == "Hospitality & Tourism"
    places = {r["title_clean"]: r["location_key"] for r in t["fact"].collect()}
    assert places["Odd"] == -3 and places["Backend Developer"] == -2 and places["Nurse"] == -1
    chef = t["fact"].filter("title_clean = 'Chef'").first()
    assert chef["days_advertised"] is None and t["dim_date"].count() == 14977 and t["dim_location"].count() == 50
    keys = {r["job_key"]: r["job_posting_key"] for r in t["fact"].collect()}
    later = NOW + timedelta(days=1)
    more = {"myjobmag": postings.MYJOBMAG + [postings.schema_org("https://m.example/job/9", "Teacher", "School", "Embu", "2026-01-06")]}
    again = daily.run_daily(lake, fetchers(more), later, send=send, waits=(), environment={})
    assert again.outcomes["myjobmag"]["inserted"] == 1 and again.clean_rows == 11
    new = {r["job_key"]: r["job_posting_key"] for r in daily.view_tables(lake)["fact"].collect()}
    assert {k: new[k] for k in keys} == keys and len(set(new.values())) == 11
    assert lake.read("runs", "id long, status string").count() == 2
    told = daily.health(lake)
    assert told["last_good_run"] is not None and told["failing"].count() > 0


def test_throttling_refusal_and_gates(spark, tmp_path):
    lake = lake_of(spark, tmp_path)
    empty = {"jsearch": lambda s, f: postings.frame(s, postings.JSEARCH).limit(0)}
    with pytest.raises(daily.RunFailed):  # nothing raw: the raw gate fails and nothing is built
        daily.run_daily(lake, empty, NOW, waits=(), environment=KEYS)
    assert lake.published("clean", "job_postings") is None
    daily.ingest(lake, "jsearch", postings.frame(spark, postings.JSEARCH), NOW)
    assert daily.run_source(lake, "jsearch", None, NOW + timedelta(hours=3))["status"] == "throttled"
    with pytest.raises(policy.SourceRefused):
        daily.run_source(lake, "fuzu", None, NOW, environment={})
    with pytest.raises(policy.SourceRefused):
        policy.require("never heard of")
    assert daily.configured_sources(["jooble", "oyk"], {}) == (["oyk"], {"jooble": "JOOBLE_API_KEY is not set"})


def test_retries():
    calls, waited = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("down")
        return {"status": "ok"}

    assert daily.with_retries(flaky, [60, 300], sleep=waited.append) == {"status": "ok"} and waited == [60, 300]


def test_alerts_are_not_repeated(spark, tmp_path):
    lake = lake_of(spark, tmp_path)
    send = lambda *a: ["mail"]
    assert daily.alert(lake, "error", "s", "b", NOW, send, "x") == {"sent": ["mail"]}
    assert daily.alert(lake, "error", "s", "b", NOW + timedelta(hours=2), send, "x") == {"skipped": "duplicate"}
    assert daily.alert(lake, "error", "s", "b", NOW + timedelta(hours=13), send, "x") == {"sent": ["mail"]}
    assert daily.alert(lake, "error", "s", "b", NOW, lambda *a: 1 / 0, "y") == {"sent": []}


def test_sightings(spark):
    log = spark.createDataFrame([("s", "a", date(2026, 1, 1), False)], "source string, job_key string, seen_on date, fetched boolean")
    seen = spark.createDataFrame([("s", "a", date(2026, 1, 1), True), ("s", "b", date(2026, 1, 2), False)], log.schema)
    once = versions.record_sightings(log, seen)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, versions.record_sightings(once, seen).collect())) == [("s", "a", date(2026, 1, 1), True), ("s", "b", date(2026, 1, 2), False)]
    assert [r[0] for r in versions.fresh_keys(once, "s", F.lit(date(2026, 1, 3)), 2).collect()] == ["a"]
    assert versions.fresh_keys(once, "s", F.lit(date(2026, 1, 4)), 2).isEmpty()


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "k int, v string, g string")
    new = spark.createDataFrame([(2, "B", "y"), (3, "c", "y"), (3, "c", "y")], old.schema)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(merge.insert_ignore(old, new, ["k"])) == [(1, "a", "x"), (2, "b", "x"), (3, "c", "y")]
    assert rows(merge.upsert(old, new.distinct(), ["k"])) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "y")]
    assert len(rows(merge.replace_groups(old, new, "g"))) == 5
    registry = spark.createDataFrame([("a", 7)], "v string, key long")
    keys = dict(map(tuple, merge.register_keys(registry, new.union(old), "v", "key").collect()))
    assert keys["a"] == 7 and sorted(keys.values()) == [7, 8, 9, 10]


def test_publishing_is_atomic(spark, tmp_path):
    root = str(tmp_path / "p")
    assert merge.current_version(spark, root) is None
    merge.publish({"t": spark.range(1)}, root)
    merge.publish({"t": spark.range(2)}, root)
    assert merge.read_current(spark, root, "t").count() == 2


def test_quality_checks(spark):
    t = {"x.t": spark.createDataFrame([(1, "x"), (2, None), (2, "y"), (3, None)], "a int, b string"), "x.r": spark.createDataFrame([(1,), (2,)], "id int")}
    checks = [
        quality.not_null("x.t", "b"), quality.not_null("x.t", "b", max_fraction=0.5), quality.unique("x.t", ["a"]), quality.accepted_values("x.t", "b", ["x"]), quality.relationships("x.t", "a", "x.r", "id"),
        quality.expression_is_true("x.t", "b = 'x'", "b_is_x"), quality.row_count_between("x.t", 5), quality.expression_is_true("x.t", "no_such = 1", "broken"),
    ]
    got = quality.run_checks(checks, t)
    assert [(r.violations, r.total, r.passed) for r in got[2:7]] == [(1, 4, False), (1, 4, False), (1, 4, False), (1, 4, False), (1, 1, False)]
    assert (got[0].violations, got[0].passed) == (2, False) and not got[7].passed and "did not run" in got[7].detail
    assert quality.exit_code(got) == 1


def test_volume_and_freshness(spark):
    rows = [("s", f"k{i}", date(2026, 1, d), True) for d, n in ((1, 10), (2, 10), (3, 10), (4, 4)) for i in range(n)]
    t = {"raw.sightings": spark.createDataFrame(rows, "source string, job_key string, seen_on date, fetched boolean")}
    checks = [quality.volume_drop("s"), quality.volume_drop("none"), quality.seen_recently("s", date(2026, 1, 6)), quality.seen_recently("s", date(2026, 1, 9)), quality.seen_recently("none", date(2026, 1, 6), allow_empty=True)]
    assert [(r.passed, r.detail) for r in quality.run_checks(checks, t)] == [(False, "1 of 1 violate"), (True, "nothing to check"), (True, "0 of 1 violate"), (False, "1 of 1 violate"), (True, "0 of 1 violate")]
    assert len(quality.all_checks(date(2026, 1, 1), ["s"])) == 42


GRAPH = """<html><head><title>T</title><meta property="og:title" content="Cook in Embu"><meta name="description" content="d">
<script type="application/ld+json">{"@graph": [{"@type": "JobPosting", "title": "Cook", "hiringOrganization": {"@id": "#o"}, "jobLocation": {"@id": "#p"}, "datePosted": "2026-01-02"},
{"@id": "#o", "@type": "Organization", "name": "Inn"}, {"@id": "#p", "@type": "Place", "address": {"addressLocality": "Embu"}}]}</script></head><body><h1>Cook</h1></body></html>"""
LABELLED = """<html><body><h1>Driver at Haul Co</h1><a href="/jobs-at/haul">View Jobs at Haul Co</a><span>Posted: Sep 22, 2026</span><ul><li><b>Job Type</b><i>Full Time</i></li>
<li>Location</li><li><a href="/jobs-location/embu">Embu</a></li><li>Job Field</li><li><a href="/jobs-by-field/transport">Transport</a></li></ul><p>Drive trucks.</p><script>no()</script><h3>Method of Application</h3><p>Mail us</p></body></html>"""
ARTICLE = """<html><head><script type="application/ld+json">{"@type": "Article", "datePublished": "2026-02-01"}</script></head><body><nav>menu</nav><article><h1>12 Vacancies Open At Java House – September 2026</h1>
<p>Location: Nairobi Employment Type: Full time Application Deadline: 5 March 2026</p></article></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([(GRAPH, "linked"), (LABELLED, "labelled"), (ARTICLE, "article"), ("<p>none</p>", "none")], "h string, s string").withColumn("u", F.lit("u"))
    got = {s: json.loads(r) if (r := pages.page_records(df.filter(F.col("s") == s), "h", "u", s).select(F.to_json("record")).first()[0]) else None for s in ("linked", "labelled", "article")}
    assert pages.page_records(df.filter("s = 'none'"), "h", "u", "article").first()["record"] is None
    jp = got["linked"]["job_posting"]
    assert jp["hiringOrganization"]["name"] == "Inn" and jp["jobLocation"]["address"]["addressLocality"] == "Embu" and got["linked"]["page_meta"]["og_title"] == "Cook in Embu"
    jp = got["labelled"]["job_posting"]
    assert (jp["title"], jp["hiringOrganization"]["name"], jp["datePosted"], jp["employmentType"], jp["industry"], jp["description"]) == ("Driver", "Haul Co", "2026-09-22", "Full Time", "Transport", "Drive trucks.")
    jp = got["article"]["job_posting"]
    assert (jp["hiringOrganization"]["name"], jp["datePosted"], jp["validThrough"], jp["employmentType"], got["article"]["vacancy_count"], got["article"]["is_roundup"]) == ("Java House", "2026-02-01", "2026-03-05", "Full time", 12, True)


def test_links(spark):
    html = '<a href="/job/a">1</a><a href="/job/a#x">2</a><a href="/job/b?q=1">3</a><a href="https://other.example/job/c">4</a><a href="/job/d/save">5</a><a href="job/e">6</a><a href="/2026/01/02/slug/">7</a>'
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(pages.links(F.col("h"), "https://m.example", pages.JOB_PATH)).first()[0] == ["https://m.example/job/a", "https://m.example/job/e"]
    assert df.select(pages.links(F.col("h"), "https://m.example", pages.POST_PATH)).first()[0] == ["https://m.example/2026/01/02/slug/"]


def test_paged_source(spark):
    read = lambda **o: paging.read_paged(spark, queries='["a", "b"]', **o)
    assert read(fetch="fake_api:offset_pages", size="3").count() == 14
    assert read(fetch="fake_api:cursor_pages", style="cursor", budget="4").count() == 4
    assert paging.shares(4, 2) == [2, 2] and paging.shares(5, 2) == [2, 2] and paging.shares(2, 3) == [1, 1, 0]
    # one set of keys over all queries: what two of them find comes once, from the first
    numbered = read(fetch="fake_api:numbered_pages", style="number", budget="9").collect()
    assert sorted((r.item_key, json.loads(r.payload)["by"]) for r in numbered) == [("1", "a"), ("2", "a")]
    found = read(fetch="fake_api:short_cursors", style="cursor").collect()
    assert sorted((r.item_key, r.query) for r in found) == sorted([(f"{q}-{i}", q) for q in "ab" for i in range(3)] + [(f"common-{i}", "a") for i in range(3)])
    assert [r.item_key for r in read(fetch="fake_api:short_cursors", style="cursor", most=3).collect()] == ["a-0", "common-0", "a-1"]
    assert paging.split_observed({"a": 1, "b": 2, "c": 3}, ["b"], ["c"]) == {"job": {"a": 1}, "observed": {"b": 2}}


def test_paged_stream_goes_on_where_it_stopped(spark, tmp_path):
    """Two pages a trigger; a new query over the checkpoint goes on from its cursors."""
    for name, most, want in (("one", 1, {"a-0", "b-0", "common-0"}), ("rest", None, {f"{x}-{i}" for x in ("a", "b", "common") for i in range(3)})):
        rows = paging.stream_paged(spark, queries='["a", "b"]', fetch="fake_api:short_cursors", style="cursor", budget="2")
        out = rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="0 seconds").start()
        for _ in range(600):
            keys = {r.item_key for r in spark.read.schema("item_key string").parquet(str(tmp_path / "out")).collect()} if (tmp_path / "out").exists() else set()
            if len(out.recentProgress) >= 1 and keys >= want:
                break
            time.sleep(0.2)
        out.stop()
        assert keys >= want, name
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.item_key for r in rows) == sorted(want)


def test_paged_stream_reads_a_range_again():
    stream = paging._Stream(paging._Settings({"queries": '["a", "b"]', "fetch": "fake_api:short_cursors", "style": "cursor", "budget": "3"}))
    start = stream.initialOffset()
    rows, end = stream.read(start)
    rows = list(rows)
    assert end == {"at": [{"cursor": "c2"}, {"cursor": "c1"}], "items": [6, 3]} and sorted(stream.readBetweenOffsets(start, end), key=str) == sorted(rows, key=str)
    more, last = stream.read(end)
    assert len(list(more)) == 9 and last == {"at": [None, None], "items": [9, 9]} and list(stream.read(last)[0]) == []


def jobs(spark):
    rows = [(1, "Data 50% Analyst", "Acme", "Nairobi", "county", "Tech", ["Python", "SQL"], True, False, date(2026, 1, 2)), (2, "Cook", None, "Embu", "county", "Food", [], False, True, None), (3, "Dev", "B", "Remote", "remote", "Tech", ["SQL"], False, True, date(2026, 1, 3))]
    return spark.createDataFrame(rows, "job_posting_key long, title string, company_name string, county_name string, location_type string, category string, skills array<string>, has_salary boolean, is_remote boolean, date_posted date")


def test_search_and_match(spark):
    found = lambda **f: [r[0] for r in serving.search(jobs(spark), **f)[0].select("job_posting_key").collect()]
    assert found() == [3, 1, 2] and found(text="50%") == [1] and found(text="5_%") == [] and found(skills=["SQL", "Python"]) == [3, 1]
    assert found(skills=["SQL", "Python"], all_skills=True) == [1] and found(remote=True, categories=["Tech"]) == [3] and found(posted_since=date(2026, 1, 3)) == [3]
    assert serving.search(jobs(spark), with_salary=True)[1].first()[0] == 1
    assert [(r["job_posting_key"], r["matched"], r["missing"]) for r in serving.cv_match(jobs(spark), ["SQL", "Go"]).collect()] == [(3, ["SQL"], []), (1, ["SQL"], ["Python"])]
    assert [tuple(r) for r in serving.filter_options(jobs(spark), "skills").collect()] == [("SQL", 2), ("Python", 1)]
    assert serving.kpis(jobs(spark)).first()["counties"] == 2


def test_public_catalog(spark):
    c = serving.PublicCatalog({"v_public_jobs": jobs(spark), "secret": jobs(spark)})
    assert c.names() == ["v_public_jobs"]
    with pytest.raises(PermissionError):
        c.read("secret")
    with pytest.raises(PermissionError):
        serving.PublicCatalog({"v_public_jobs": jobs(spark).withColumn("description_text", F.lit(""))})


def test_stream_loads_each_version_once(spark, tmp_path):
    from tidemark.streaming import ingest

    root, target, checkpoint = str(tmp_path), str(tmp_path / "t"), str(tmp_path / "c")
    load = lambda: ingest.load_available(spark, root, target, checkpoint).awaitTermination(120)
    raw_layer.write_batch(raw_rows(spark, "jsearch"), root)
    load()
    load()
    assert ingest.loaded(spark, target).count() == 2
    # a version that returns a year later is no new one, a changed posting is
    later = NOW + timedelta(days=400)
    changed = [{**p, "more": 1} if i == 0 else p for i, p in enumerate(postings.JSEARCH)]
    raw_layer.write_batch(raw_layer.wrap(postings.frame(spark, changed), "jsearch", "r2", later), root)
    load()
    assert ingest.loaded(spark, target).count() == 3
    assert sorted((r.batch, r.seen, r.inserted) for r in ingest.ledger(spark, target).collect()) == [(0, 2, 2), (1, 2, 1)]
    # a batch that is run again, after all of it or after its rows only, leaves the same
    before = sorted((r.job_key, r.content_hash, r.batch) for r in ingest.loaded(spark, target).collect())
    again = spark.read.schema(ingest.FILES).json(f"{root}/raw").filter("run_id = 'r2'")
    ingest.load_batch(again, 1, target)
    assert sorted((r.job_key, r.content_hash, r.batch) for r in ingest.loaded(spark, target).collect()) == before
    assert ingest.ledger(spark, target).count() == 2


def test_latest_snapshots(spark, tmp_path):
    urls = ["https://a.example/1", "https://a.example/2", "https://a.example/unsaved"]
    for url, day, html, packed in ((urls[0], "2026-01-01", "<p>old", True), (urls[0], "2026-01-03", "<p>neu é", True), (urls[1], "2026-01-02", "<p>plain", False), ("https://b.example/unknown", "2026-01-09", "<p>x", True)):
        folder = tmp_path / "raw_html" / "source=s" / f"dt={day}"
        folder.mkdir(parents=True, exist_ok=True)
        name = hashlib.sha1(url.encode()).hexdigest()[:16]
        (folder / f"{name}.html{'.gz' if packed else ''}").write_bytes(gzip.compress(html.encode()) if packed else html.encode())
    (tmp_path / "raw_html" / "source=s" / "dt=2026-01-02" / f"{hashlib.sha1(urls[1].encode()).hexdigest()[:16]}.html.gz").write_bytes(gzip.compress(b"<p>packed"))
    got = raw_layer.latest_snapshots(raw_layer.read_snapshots(spark, str(tmp_path)), spark.createDataFrame([(u,) for u in urls], "url string"))
    assert sorted((r.url, str(r.dt), r.html) for r in got.collect()) == [(urls[0], "2026-01-03", "<p>neu é"), (urls[1], "2026-01-02", "<p>packed")]


def test_weekly_arrivals_are_exact(spark, tmp_path):
    from tidemark.streaming import ingest

    rows = [("s", f"k{i % 700}", NOW + timedelta(hours=i % 160)) for i in range(2000)] + [("s", "late", NOW + timedelta(days=40))]
    spark.createDataFrame(rows, "source string, job_key string, scraped_at timestamp").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("source string, job_key string, scraped_at timestamp").parquet(str(tmp_path / "in"))
    out = ingest.weekly_arrivals(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
    out.awaitTermination(180)
    batch = spark.read.parquet(str(tmp_path / "in")).filter("job_key <> 'late'").groupBy(F.date_trunc("week", "scraped_at").cast("date").alias("week_start"), "source").agg(F.countDistinct("job_key").alias("postings"))
    rows = lambda df: sorted((r.week_start, r.source, r.postings) for r in df.collect())
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(batch) and len(rows(batch)) == 2


def test_replay_rebuilds_from_the_files(spark, tmp_path):
    lake, files = lake_of(spark, tmp_path), str(tmp_path / "files")
    days = [NOW, NOW + timedelta(days=1), NOW + timedelta(days=2)]
    for source in ("jsearch", "myjobmag"):
        for at in days:
            daily.ingest(lake, source, postings.frame(spark, [{**p, "day": at.day} for p in postings.BY_SOURCE[source]]), at, files)
    whole = {(r.source, r.job_key, r.content_hash) for r in lake.raw().collect()}
    fresh = daily.Lake(spark, str(tmp_path / "fresh"))
    part = daily.replay(fresh, files, NOW, "jsearch", "2026-01-07", "2026-01-07")
    assert part == {"jsearch": {"seen": 2, "inserted": 2}} and fresh.raw().count() == 2
    assert daily.replay(fresh, files, NOW)["jsearch"] == {"seen": 6, "inserted": 4}
    assert {(r.source, r.job_key, r.content_hash) for r in fresh.raw().collect()} == whole and len({r.id for r in fresh.raw().collect()}) == len(whole)
    assert sorted(map(tuple, fresh.sightings().collect())) == sorted(map(tuple, lake.sightings().collect()))
    again = daily.replay(fresh, files, NOW)
    assert {of["inserted"] for of in again.values()} == {0} and fresh.raw().count() == len(whole)
    assert daily.replay(fresh, files, NOW, since="2030-01-01") == {}


def test_empty_inputs(spark):
    none = clean.clean(spark.createDataFrame([], "id long, source string, job_key string, payload variant, first_seen timestamp, last_seen timestamp"))
    assert none.count() == 0 and clean.profile(none).first()["postings"] == 0
