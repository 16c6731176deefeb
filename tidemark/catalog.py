"""Every registered query of the posting engine, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import lens
from tidemark.functions import classify, dates, skills, stats, text
from tidemark.lens import LENS_SQL, read
from tidemark.operators import merge, versions
from tidemark.plans import quality, serving, views, warehouse
from tidemark.sources import pages, raw_layer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, lensed: bool = False) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = LENS_SQL + sql if lensed else sql
        return f

    return add


def view(name: str, make, sql: str) -> None:
    query(name, sql, lensed=True)(lambda spark, d: make(lens.tables(spark, d)))


def over_base(name: str, make, sql: str) -> None:
    view(name, lambda t: make(views.analytics_base(t), t), sql)


def _wilson_sql(k: str, n: str, sign: str) -> str:
    bound = f"(({k}::DOUBLE / {n} + 3.8416 / (2 * {n}::DOUBLE)) {sign} 1.96 * sqrt(({k}::DOUBLE / {n}) * (1 - {k}::DOUBLE / {n}) / {n} + 3.8416 / (4 * {n}::DOUBLE * {n}))) / (1 + 3.8416 / {n})"
    clamp = f"greatest(0.0, {bound})" if sign == "-" else f"least(1.0, {bound})"
    return f"CAST(round(CAST(100 * {clamp} AS DECIMAL(38,9)), 1) AS DOUBLE)"


def _pct(k: str, n: str) -> str:
    """100 k / n to one place, halves away from zero, in whole numbers."""
    return f"CAST(CASE WHEN {n} = 0 THEN NULL ELSE floor((2000 * CAST({k} AS HUGEINT) + {n}) / (2 * {n})::DOUBLE) / 10 END AS DOUBLE)"


# ---- versions, sightings, duplicates ----

EVENTS = "event_type AS source, CAST(user_id AS VARCHAR) AS job_key, ts, event_id"


def _raw(spark: SparkSession, d: str, fetched: bool = False) -> DataFrame:
    e = read(spark, d, "events")
    e = e.filter("value > 50") if fetched else e
    return e.select(F.col("event_id").alias("id"), F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("job_key"), F.col("ts").cast("timestamp").alias("scraped_at"), F.sha2(F.concat_ws("|", "user_id", "props"), 256).alias("content_hash"), F.col("props"))


def _day(c: str) -> str:
    return f"CAST({c} + INTERVAL 3 HOUR AS DATE)"


@query("latest_version", f"SELECT source, job_key, event_id AS id FROM (SELECT {EVENTS}, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events) WHERE nth = 1")
def latest_version(spark, d):
    return versions.latest_version(_raw(spark, d), ["source", "job_key"], ["scraped_at", "id"], ["source", "job_key", "id"])


@query(
    "first_last_seen",
    f"""WITH e AS (SELECT {EVENTS} FROM events), s AS (SELECT source, job_key, min({_day("ts")}) AS a, max({_day("ts")}) AS b FROM (SELECT {EVENTS} FROM events WHERE value > 50) GROUP BY ALL),
 r AS (SELECT source, job_key, arg_max(event_id, (ts, event_id)) AS id, min(ts) AS lo, max(ts) AS hi FROM e GROUP BY ALL)
 SELECT source, job_key, id, CAST(floor(epoch(coalesce(a + INTERVAL 9 HOUR, lo))) AS BIGINT) AS first_s, CAST(floor(epoch(coalesce(b + INTERVAL 9 HOUR, hi))) AS BIGINT) AS last_s FROM r LEFT JOIN s USING (source, job_key)""",
)
def first_last_seen(spark, d):
    raw = _raw(spark, d)
    log = versions.seed_sightings(spark.createDataFrame([], "source string, job_key string, seen_on date, fetched boolean"), _raw(spark, d, fetched=True))
    found = versions.first_last_seen(raw, log)
    return found.select("source", "job_key", "id", F.unix_timestamp("first_seen").alias("first_s"), F.unix_timestamp("last_seen").alias("last_s"))


@query("sightings_daily", f"SELECT source, job_key, seen_on, bool_or(fetched) AS fetched FROM (SELECT {EVENTS}, {_day('ts')} AS seen_on, value > 50 AS fetched FROM events) GROUP BY source, job_key, seen_on")
def sightings_daily(spark, d):
    rows = read(spark, d, "events").select(F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("job_key"), dates.local_date(F.col("ts").cast("timestamp")).alias("seen_on"), (F.col("value") > 50).alias("fetched"))
    return versions.record_sightings(rows.limit(0), rows)


@query("fresh_keys", f"SELECT DISTINCT CAST(user_id AS VARCHAR) AS job_key FROM events WHERE event_type = 'click' AND {_day('ts')} >= DATE '2024-01-25' - 3")
def fresh_keys(spark, d):
    log = versions.seed_sightings(spark.createDataFrame([], "source string, job_key string, seen_on date, fetched boolean"), _raw(spark, d))
    return versions.fresh_keys(log, "click", F.lit(date(2024, 1, 25)), 3)


@query("insert_ignore", "SELECT DISTINCT event_type AS source, CAST(user_id AS VARCHAR) AS job_key, sha256(concat_ws('|', user_id, props)) AS content_hash FROM events")
def insert_ignore(spark, d):
    raw, keys = _raw(spark, d), ["source", "job_key", "content_hash"]
    old = raw.filter("scraped_at < TIMESTAMP'2024-01-15'").select(*keys).distinct()
    return merge.insert_ignore(old, raw.filter("scraped_at >= TIMESTAMP'2024-01-10'").select(*keys), keys)


@query(
    "dedup_flags",
    """WITH k AS (SELECT doc_id, source, sha1(lower(text)) AS dedup_key FROM documents WHERE length(text) >= 100),
 r AS (SELECT *, row_number() OVER w AS nth, first_value(doc_id) OVER w AS head FROM k WINDOW w AS (PARTITION BY dedup_key ORDER BY source, lpad(CAST(doc_id AS VARCHAR), 12, '0')))
 SELECT doc_id, nth > 1 AS is_duplicate, CASE WHEN nth > 1 THEN lpad(CAST(head AS VARCHAR), 12, '0') END AS canonical_job_key FROM r
 UNION ALL SELECT doc_id, FALSE, NULL FROM documents WHERE NOT length(text) >= 100""",
)
def dedup_flags(spark, d):
    key = F.when(F.length("text") >= 100, F.sha1(F.lower("text")))
    rows = read(spark, d, "documents").select("doc_id", "source", F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("job_key"), key.alias("dedup_key"), F.lit(None).cast("date").alias("date_posted"), F.lit(None).cast("timestamp").alias("first_seen_at"))
    return versions.flag_duplicates(rows).select("doc_id", "is_duplicate", "canonical_job_key")


# ---- views over the lens ----

view("v_jobs_flat", lambda t: views.jobs(t).select("job_posting_key", "source", "company_name", "county_name", "location_type", "date_posted", "cal_year", "cal_month", "iso_week", "days_advertised"), "SELECT job_posting_key, source, company_name, county_name, location_type, date_posted, CAST(year(date_posted) AS INTEGER) AS cal_year, CAST(month(date_posted) AS INTEGER) AS cal_month, CAST(weekofyear(date_posted) AS INTEGER) AS iso_week, CAST(days_advertised AS INTEGER) AS days_advertised FROM live")
view("top_skills", views.top_skills, f"SELECT skill_name, substr(skill_name, 1, 1) AS category, postings, {_pct('postings', 'n')} AS pct_of_postings FROM (SELECT skill_name, count(*) AS postings FROM skills_of JOIN live ON l_orderkey = job_posting_key GROUP BY 1), (SELECT count(*) AS n FROM live)")
view("hiring_by_county_month", views.hiring_by_county, "SELECT county_name, location_type, CAST(year(date_posted) AS INTEGER) AS cal_year, CAST(month(date_posted) AS INTEGER) AS cal_month, count(*) AS postings FROM live GROUP BY ALL")
view("salary_by_seniority", views.salary_by_seniority, "SELECT seniority, count(*) AS postings_with_salary, CAST(round(sum(salary_mid)::DOUBLE / count(*)) AS DOUBLE) AS avg_band_midpoint_kes, CAST(round(quantile_cont(salary_mid::DOUBLE, 0.5)) AS DOUBLE) AS median_band_midpoint_kes FROM live WHERE has_salary GROUP BY seniority")
view("advertised_window", views.advertised_window, "SELECT source, count(*) AS postings, count(days_advertised) AS postings_with_window, CAST(floor((20 * sum(days_advertised) + count(days_advertised)) / (2 * count(days_advertised))::DOUBLE) / 10 AS DOUBLE) AS avg_days_advertised FROM live GROUP BY source")
view("posting_lifetimes", lambda t: views.posting_lifetimes(t).drop("title_clean"), "SELECT f.source, job_key, first_seen, last_seen, CAST(last_seen - first_seen AS INTEGER) AS days_observed, last_seen >= newest - 3 AS seen_recently FROM live f JOIN (SELECT source, max(last_seen) AS newest FROM fact GROUP BY source) n ON f.source = n.source")
_LISTED = "coalesce((SELECT string_agg(skill_name, ',' ORDER BY skill_name) FROM skills_of s WHERE s.l_orderkey = live.job_posting_key), '')"
view("jobs_enriched_skills", lambda t: views.jobs_enriched(t).select("job_posting_key", "category", F.array_join("skills", ",").alias("skills"), "publishable", "salary_mid_kes"), f"SELECT job_posting_key, category, {_LISTED} AS skills, source <> '{lens.HIDDEN_SOURCE}' AS publishable, CAST(round(salary_mid) AS INTEGER) AS salary_mid_kes FROM live")
view("source_freshness", views.source_freshness, f"SELECT source, max(seen_on) AS last_seen_on, count(DISTINCT job_key) AS postings_seen_total FROM sightings WHERE source <> '{lens.HIDDEN_SOURCE}' GROUP BY source")
over_base("public_jobs", lambda b, t: b.select("job_posting_key", "source", "category", "first_seen", "last_seen"), "SELECT job_posting_key, source, category, first_seen, last_seen FROM base")
_TECH = "category IN ('Data & Analytics', 'Software & IT')"
over_base("coverage_sources", lambda b, t: views.coverage_sources(b), f"SELECT source, postings, {_pct('postings', 'total')} AS share_pct, first_crawl, last_crawl, history_days, oldest_posted, newest_posted, {_pct('paid', 'postings')} AS pct_with_salary, {_pct('placed', 'postings')} AS pct_with_county, tech_postings FROM (SELECT source, count(*) AS postings, CAST(sum(count(*)) OVER () AS BIGINT) AS total, min(first_seen) AS first_crawl, max(last_seen) AS last_crawl, CAST(max(last_seen) - min(first_seen) + 1 AS INTEGER) AS history_days, min(date_posted) AS oldest_posted, max(date_posted) AS newest_posted, count(*) FILTER (has_salary) AS paid, count(*) FILTER (location_type = 'county') AS placed, count(*) FILTER ({_TECH}) AS tech_postings FROM base GROUP BY source)")
over_base("coverage_overall", lambda b, t: views.coverage_overall(b), f"SELECT count(*) AS postings, count(DISTINCT source) AS sources, CAST(max(last_seen) - min(first_seen) + 1 AS INTEGER) AS history_days, min(first_seen) AS first_crawl, max(last_seen) AS last_crawl, count(*) FILTER ({_TECH}) AS tech_postings, count(*) FILTER (location_type = 'county') AS county_located FROM base")
over_base(
    "skill_demand_grid",
    lambda b, t: views.skill_demand(b, t["dim_skill"]),
    f""", tech AS (SELECT * FROM base WHERE {_TECH}), totals AS (SELECT source, count(*) AS n FROM tech GROUP BY source HAVING count(*) >= 10), mentions AS (SELECT source, skill_name, count(*) AS m FROM tech JOIN skills_of ON l_orderkey = job_posting_key GROUP BY ALL),
 grid AS (SELECT k.skill_name, o.source, o.n, coalesce(m, 0) AS m FROM (SELECT DISTINCT skill_name FROM mentions) k CROSS JOIN totals o LEFT JOIN mentions x ON x.skill_name = k.skill_name AND x.source = o.source),
 g AS (SELECT skill_name, CAST(sum(m) AS BIGINT) AS k, CAST(sum(n) AS BIGINT) AS n, avg(100.0::DOUBLE * m / n) AS b, count(*) FILTER (m > 0) AS sm, count(*) AS st FROM grid GROUP BY skill_name)
 SELECT skill_name, substr(skill_name, 1, 1) AS skill_category, k AS postings, n AS n_tech, {_pct("k", "n")} AS pooled_pct, {_wilson_sql("k", "n", "-")} AS ci_low_pct, {_wilson_sql("k", "n", "+")} AS ci_high_pct, CAST(round(CAST(b AS DECIMAL(38,9)), 1) AS DOUBLE) AS balanced_pct, sm AS sources_mentioning, st AS sources_total, k >= 5 AS reliable FROM g""",
)
over_base(
    "county_summary",
    lambda b, t: views.county_summary(b),
    f""", c AS (SELECT county_name, count(*) AS postings, CAST(sum(count(*)) OVER () AS BIGINT) AS n_located, count(DISTINCT source) AS sources, count(*) FILTER (has_salary) AS n_salary, quantile_cont(salary_mid_kes::DOUBLE, 0.5) FILTER (has_salary) AS med FROM base WHERE location_type = 'county' GROUP BY county_name)
 SELECT county_name, postings, n_located, {_pct("postings", "n_located")} AS share_pct, {_wilson_sql("postings", "n_located", "-")} AS ci_low_pct, {_wilson_sql("postings", "n_located", "+")} AS ci_high_pct, sources, n_salary, CASE WHEN n_salary >= 5 THEN round(med) END AS median_salary_band_mid_kes, postings >= 10 AS reliable FROM c""",
)
_WEEKLY = """, crawl AS (SELECT source, min(first_seen) AS a, max(last_seen) AS b FROM base GROUP BY source), weekly AS (SELECT CAST(date_trunc('week', date_posted) AS DATE) AS week_start, base.source, county_name, location_type, CAST(date_trunc('week', date_posted) AS DATE) >= a AND CAST(date_trunc('week', date_posted) AS DATE) + 6 <= b AS week_complete, count(*) AS postings FROM base JOIN crawl ON base.source = crawl.source WHERE date_posted >= a GROUP BY ALL)
"""
over_base("weekly_new", lambda b, t: views.weekly_new(b), _WEEKLY + "SELECT * FROM weekly")
over_base("trend_total", lambda b, t: views.trend_pivot(views.weekly_new(b)).select("week_start", "total"), _WEEKLY + "SELECT week_start, CAST(sum(postings) AS BIGINT) AS total FROM weekly WHERE week_complete GROUP BY week_start")


def _unpivoted(b, t):
    wide = views.trend_pivot(views.weekly_new(b))
    named = [c for c in wide.columns if c not in ("week_start", "total")]
    return wide.unpivot("week_start", named, "county_name", "postings").filter("postings > 0")


over_base("trend_pivot", _unpivoted, _WEEKLY + ", top AS (SELECT county_name FROM weekly WHERE week_complete AND location_type = 'county' GROUP BY 1 ORDER BY sum(postings) DESC, county_name LIMIT 5) SELECT week_start, county_name, CAST(sum(postings) AS BIGINT) AS postings FROM weekly WHERE week_complete AND location_type = 'county' AND county_name IN (SELECT county_name FROM top) GROUP BY week_start, county_name")
_QUARTILES = f"count(*) AS postings, count(days_advertised) AS with_window, {_pct('count(days_advertised)', 'count(*)')} AS pct_with_window, " + ", ".join(f"CAST(round(CAST(quantile_cont(days_advertised::DOUBLE, {p}) AS DECIMAL(38,9)), 1) AS DOUBLE) AS {n}" for p, n in ((0.25, "p25_days"), (0.5, "median_days"), (0.75, "p75_days")))
over_base("advertised_window_stats", lambda b, t: views.advertised_window_stats(b), f"SELECT source, {_QUARTILES} FROM base GROUP BY source UNION ALL SELECT 'all', {_QUARTILES} FROM base")
_DEPTH = f"SELECT s.source, s.seen_on, count(*) AS postings_seen, min(date_posted) AS oldest_posted, max(date_posted) AS newest_posted, CAST(max(date_posted) - min(date_posted) AS INTEGER) AS window_days FROM sightings s JOIN fact f ON f.source = s.source AND f.job_key = s.job_key WHERE s.source <> '{lens.HIDDEN_SOURCE}' GROUP BY s.source, s.seen_on"
view("feed_depth", views.feed_depth, _DEPTH)
_OBS = """, days AS (SELECT DISTINCT source, seen_on FROM sightings), begun AS (SELECT source, min(first_seen) AS a FROM base GROUP BY source), edge AS (SELECT source, seen_on AS e FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seen_on DESC) AS nth FROM days) WHERE nth = 3),
 obs AS (SELECT b.source, job_posting_key, greatest(CAST(last_seen - date_posted + 1 AS INTEGER), 1) AS duration_days, coalesce(e > last_seen, FALSE) AS left_listing FROM base b JOIN begun USING (source) LEFT JOIN edge USING (source) WHERE date_posted >= a)
"""
_KM = """, steps AS (SELECT source, duration_days AS t, count(*) AS c, count(*) FILTER (left_listing) AS d FROM obs GROUP BY ALL), risk AS (SELECT source, t, d, sum(c) OVER (PARTITION BY source ORDER BY t DESC) AS n FROM steps),
 km AS (SELECT source, t AS age_days, CAST(n AS BIGINT) AS at_risk, d AS n_events, round(exp(sum(ln(greatest(1 - d::DOUBLE / n, 1e-9))) OVER (PARTITION BY source ORDER BY t)), 4) AS survival FROM risk)
"""
over_base("lifetime_observations", lambda b, t: views.lifetime_observations(b, t["sightings"]), _OBS + "SELECT * FROM obs")
over_base("lifetime_km", lambda b, t: views.lifetime_km(views.lifetime_observations(b, t["sightings"])), _OBS + _KM + "SELECT * FROM km")
over_base(
    "lifetime_summary",
    lambda b, t: views.lifetime_summary(views.lifetime_observations(b, t["sightings"]), views.feed_depth(t)),
    _OBS + _KM + f""", depth AS ({_DEPTH}), o AS (SELECT source, count(*) AS n, count(*) FILTER (left_listing) AS x FROM obs GROUP BY source), m AS (SELECT source, min(age_days) AS med FROM km WHERE survival <= 0.5 GROUP BY source), w AS (SELECT source, quantile_cont(window_days::DOUBLE, 0.5) AS w FROM depth GROUP BY source)
 SELECT o.source, n AS cohort_postings, x AS left_listing, n - x AS still_visible, med AS median_days, CAST(round(CAST(w AS DECIMAL(38,9)), 1) AS DOUBLE) AS feed_window_days, x >= 30 AND med IS NOT NULL AND med > 1.5 * w AS trustworthy FROM o LEFT JOIN m USING (source) LEFT JOIN w USING (source)""",
)

# ---- serving ----

_SHOWN = f"(SELECT *, {_LISTED.replace('live.', 'base.')} AS listed FROM base)"
over_base("kpi", lambda b, t: serving.kpis(b), f"SELECT count(*) AS postings, count(DISTINCT company_name) AS companies, count(DISTINCT CASE WHEN location_type = 'county' THEN county_name END) AS counties, {_pct('count(*) FILTER (has_salary)', 'count(*)')} AS pct_with_salary, max(date_posted) AS newest FROM base")
over_base("filter_options", lambda b, t: serving.filter_options(b, "skills"), "SELECT skill_name AS value, count(*) AS postings FROM skills_of JOIN base ON l_orderkey = job_posting_key GROUP BY 1")
over_base("search", lambda b, t: serving.search(b, text="data", skills=["SMALL", "ECONOMY", "STANDARD", "PROMO"], with_salary=True)[0].select("job_posting_key", "title", "date_posted"), "SELECT job_posting_key, title, date_posted FROM base WHERE (title ILIKE '%data%' OR company_name ILIKE '%data%') AND has_salary AND job_posting_key IN (SELECT l_orderkey FROM skills_of WHERE skill_name IN ('SMALL', 'ECONOMY', 'STANDARD', 'PROMO')) ORDER BY date_posted DESC NULLS LAST, job_posting_key LIMIT 500")
over_base("daily_series", lambda b, t: serving.daily_series(b, date(2011, 7, 1)), "SELECT date_posted, count(*) AS postings FROM base WHERE date_posted >= DATE '2011-07-01' - 30 GROUP BY date_posted")
over_base("top_categories", lambda b, t: serving.top(b, "category", 15), "SELECT category AS value, count(*) AS postings FROM base GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")


def _skill_match(b, t):
    own = [r["skill_name"] for r in t["dim_skill"].select("skill_name").orderBy("skill_name").limit(3).collect()]
    return serving.cv_match(b, own).select("job_posting_key", "overlap", F.array_join("matched", ",").alias("matched"), F.array_join("missing", ",").alias("missing"))


over_base("skill_match", _skill_match, ", own AS (SELECT DISTINCT skill_name FROM skills_of ORDER BY 1 LIMIT 3) SELECT job_posting_key, CAST(count(*) FILTER (skill_name IN (SELECT skill_name FROM own)) AS INTEGER) AS overlap, coalesce(string_agg(skill_name, ',' ORDER BY skill_name) FILTER (skill_name IN (SELECT skill_name FROM own)), '') AS matched, coalesce(string_agg(skill_name, ',' ORDER BY skill_name) FILTER (skill_name NOT IN (SELECT skill_name FROM own)), '') AS missing FROM base JOIN skills_of ON l_orderkey = job_posting_key GROUP BY job_posting_key, date_posted HAVING count(*) FILTER (skill_name IN (SELECT skill_name FROM own)) > 0 ORDER BY 2 DESC, date_posted DESC, job_posting_key LIMIT 25")

# ---- warehouse and statistics ----


@query("dim_date", "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS cal_year, CAST(quarter(d) AS INTEGER) AS cal_quarter, CAST(month(d) AS INTEGER) AS cal_month, monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS iso_week, CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS iso_dow, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend FROM range(DATE '2000-01-01', DATE '2041-01-01', INTERVAL 1 DAY) t(d) UNION ALL SELECT -1, NULL, NULL, NULL, NULL, 'Unknown', NULL, NULL, NULL, 'Unknown', NULL")
def dim_date(spark, d):
    return warehouse.dim_date(spark)


@query("wilson", f"SELECT k, n, {_wilson_sql('k', 'n', '-')} AS low_pct, {_wilson_sql('k', 'n', '+')} AS high_pct FROM (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS k, count(*) AS n FROM lineitem GROUP BY l_suppkey)")
def wilson(spark, d):
    counted = read(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("k"), F.count(F.lit(1)).alias("n"))
    return counted.select("k", "n", views.rounded(100 * stats.wilson_low(F.col("k"), F.col("n")), 1).alias("low_pct"), views.rounded(100 * stats.wilson_high(F.col("k"), F.col("n")), 1).alias("high_pct"))


# ---- text over documents and pages ----


@query("redact_contacts", r"SELECT doc_id, len(regexp_extract_all(text, '[\w.+-]+@[\w-]+\.[\w.-]+')) AS masked FROM documents WHERE regexp_matches(text, '[\w.+-]+@[\w-]+\.[\w.-]+')")
def redact_contacts(spark, d):
    clean = F.regexp_count(text.redact_contacts(F.col("text")), F.lit(r"\[email\]"))
    return read(spark, d, "documents").select("doc_id", clean.cast("long").alias("masked")).filter("masked > 0")


@query("norm_text", "SELECT c_custkey, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) AS norm FROM customer")
def norm_text(spark, d):
    return read(spark, d, "customer").select("c_custkey", text.norm_text(F.col("c_name")).alias("norm"))


@query("norm_text_documents", "SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(lower(strip_accents(text)), 'ß', '', 'g'), '[^a-z0-9]+', ' ', 'g'))) AS norm_sha256 FROM documents")
def norm_text_documents(spark, d):
    return read(spark, d, "documents").select("doc_id", F.sha2(text.norm_text(F.col("text")), 256).alias("norm_sha256"))


@query("parse_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def parse_date(spark, d):
    return read(spark, d, "events").select("event_id", text.parse_date(F.concat(F.lit("on "), F.col("ts").cast("string"))).alias("day"))


@query("classify_category", "SELECT title, category, count(*) AS n FROM fact GROUP BY ALL", lensed=True)
def classify_category(spark, d):
    rows = lens.tables(spark, d)["fact"]
    return rows.groupBy(F.col("title_clean").alias("title"), classify.classify_category(F.col("title_clean"), F.col("industry")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


_TERMS = ["the", "and", "des", "und", "que", "licensed", "token", "is", "of", "een"]


@query("skill_extract", "SELECT doc_id, term AS skill FROM documents, (VALUES " + ", ".join(f"('{t}')" for t in _TERMS) + ") v(term) WHERE regexp_matches(lower(regexp_replace(text, '[-_]', ' ', 'g')), '(^|[^a-z0-9+#.])' || term || '($|[^a-z0-9+#])')")
def skill_extract(spark, d):
    terms = spark.createDataFrame([(t, t) for t in _TERMS], "alias string, skill string")
    return skills.match_terms(read(spark, d, "documents"), "doc_id", "text", F.broadcast(terms))


@query("html_title_h1_links", r"SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1), '\s+', ' ', 'g')) AS title, trim(regexp_replace(regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1), '\s+', ' ', 'g')) AS h1, (length(html) - length(replace(html, '<a href=', ''))) // 8 AS links FROM pages")
def html_title_h1_links(spark, d):
    p = read(spark, d, "pages")
    n = F.regexp_count("html", F.lit(r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"'][^\"']*[\"']"))
    return p.select("page_id", pages.tag_text(F.col("html"), "title").alias("title"), pages.tag_text(F.col("html"), "h1").alias("h1"), n.cast("long").alias("links"))


@query("page_records")
def page_records(spark, d):
    found = pages.page_records(read(spark, d, "pages"), style="article")
    return found.select("page_id", F.try_variant_get("record", "$.job_posting.title", "string").alias("title"), F.length(F.try_variant_get("record", "$.job_posting.description", "string")).alias("chars"))


@query("html_to_text")
def html_to_text(spark, d):
    return read(spark, d, "pages").select("page_id", text.html_to_text(F.col("html")).alias("text"))


@query("variant_paths", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_type(props) = 'OBJECT' AS is_object FROM events")
def variant_paths(spark, d):
    v = F.parse_json("props")
    return read(spark, d, "events").select("event_id", F.try_variant_get(v, "$.k", "long").alias("k"), F.schema_of_variant(v).startswith("OBJECT").alias("is_object"))


@query("content_hash")
def content_hash(spark, d):
    v = F.parse_json("props")
    return read(spark, d, "events").select("event_id", raw_layer.content_hash(v).alias("content_hash"), raw_layer.job_key(v).alias("job_key"))


# ---- data quality ----


def _dq(name: str, check: quality.Check, table: str, sql: str) -> None:
    def run(spark, d):
        t = {n: read(spark, d, n) for n in {table, "orders", "customer"}}
        if check.frame is not None:
            return check.frame(t).select(F.col("violations").cast("long").alias("violations"), F.col("total").cast("long").alias("total"))
        v, n = check.columns()
        return t[table].agg(v.cast("long").alias("violations"), n.cast("long").alias("total"))

    query(name, sql)(run)


_dq("dq_not_null", quality.not_null("labels", "quality"), "labels", "SELECT count(*) FILTER (quality IS NULL) AS violations, count(*) AS total FROM labels")
_dq("dq_unique", quality.unique("lineitem", ["l_orderkey", "l_linenumber"]), "lineitem", "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations, CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
_dq("dq_accepted_values", quality.accepted_values("events", "event_type", ["click", "view"]), "events", "SELECT count(*) FILTER (event_type NOT IN ('click', 'view')) AS violations, count(*) AS total FROM events")
_dq("dq_relationships", quality.relationships("lineitem", "l_orderkey", "orders", "o_orderkey"), "lineitem", "SELECT count(*) FILTER (o_orderkey IS NULL) AS violations, count(*) AS total FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey")
_dq("dq_expression", quality.expression_is_true("lineitem", "l_quantity <= 40", "q", where="l_returnflag = 'R'"), "lineitem", "SELECT count(*) FILTER (NOT l_quantity <= 40) AS violations, count(*) AS total FROM lineitem WHERE l_returnflag = 'R'")
_dq("dq_row_count", quality.row_count_between("orders", 1, 10), "orders", "SELECT CASE WHEN count(*) < 1 OR count(*) > 10 THEN 1 ELSE 0 END::BIGINT AS violations, 1::BIGINT AS total FROM orders")
_dq("dq_max_age", quality.max_age_days("orders", "o_orderdate", 14, date(2001, 9, 1)), "orders", "SELECT CASE WHEN max(o_orderdate) IS NULL OR max(o_orderdate) < DATE '2001-09-01' - 14 THEN 1 ELSE 0 END::BIGINT AS violations, 1::BIGINT AS total FROM orders")


@query("dq_volume_drop", f"WITH s AS (SELECT {_day('ts')} AS seen_on, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1), r AS (SELECT n, row_number() OVER (ORDER BY seen_on DESC) AS nth FROM s) SELECT CASE WHEN count(*) FILTER (nth BETWEEN 2 AND 8) >= 3 AND max(n) FILTER (nth = 1) < 0.9 * avg(n) FILTER (nth BETWEEN 2 AND 8) THEN 1 ELSE 0 END::BIGINT AS violations, 1::BIGINT AS total FROM r")
def dq_volume_drop(spark, d):
    seen = read(spark, d, "events").select(F.col("event_type").alias("source"), dates.local_date(F.col("ts").cast("timestamp")).alias("seen_on"))
    return quality.volume_drop("view", 0.9).frame({"raw.sightings": seen}).select(F.col("violations").cast("long").alias("violations"), F.col("total").cast("long").alias("total"))


def _results(spark, d) -> DataFrame:
    e = read(spark, d, "events")
    return e.select(F.concat(F.lit("check_"), F.col("user_id")).alias("check_name"), F.lit("raw").alias("layer"), F.when(F.col("user_id") % 2 == 0, "error").otherwise("warn").alias("severity"), (F.col("value") < 40).alias("passed"), F.col("event_id").alias("violations"), F.lit(1).cast("long").alias("total"), F.lit("").alias("detail"), F.col("ts").alias("run_at"))


_LATEST = "SELECT DISTINCT ON (user_id) 'check_' || user_id AS check_name, user_id, value, event_id FROM events ORDER BY user_id, ts DESC"


@query("latest_dq", f"SELECT check_name, value < 40 AS passed, event_id AS violations FROM ({_LATEST})")
def latest_dq(spark, d):
    return views.latest_dq(_results(spark, d)).select("check_name", "passed", "violations")


@query("public_dq_summary", f"SELECT 'raw' AS layer, count(*) AS checks, count(*) FILTER (value < 40) AS passed, count(*) FILTER (NOT value < 40 AND user_id % 2 = 0) AS failing_errors, count(*) FILTER (NOT value < 40 AND user_id % 2 <> 0) AS failing_warnings FROM ({_LATEST})")
def public_dq_summary(spark, d):
    return views.public_dq_summary(_results(spark, d)).drop("last_checked")


@query("public_runs", "SELECT o_orderkey AS id, CAST(o_orderkey % 100 AS INTEGER) AS duration_s FROM orders ORDER BY 1 DESC LIMIT 30")
def public_runs(spark, d):
    start = F.col("o_orderdate").cast("timestamp")
    runs = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), start.alias("started_at"), F.timestamp_seconds(F.unix_timestamp(start) + F.col("o_orderkey") % 100).alias("finished_at"), F.lit("ok").alias("status"))
    return views.public_runs(runs).select("id", "duration_s")


@query("stable_keys", "SELECT count(*) AS members, count(*) AS distinct_keys, max(nth) AS last_key FROM (SELECT row_number() OVER () AS nth FROM (SELECT DISTINCT c_name FROM customer))")
def stable_keys(spark, d):
    names = read(spark, d, "customer").select(F.col("c_name").alias("member"))
    old = merge.register_keys(spark.createDataFrame([], "member string, key long"), names.filter("member < 'Customer#000000500'"), "member", "key")
    return merge.register_keys(old, names, "member", "key").agg(F.count(F.lit(1)).alias("members"), F.countDistinct("key").alias("distinct_keys"), F.max("key").alias("last_key"))


def _running(spark, d):
    per = read(spark, d, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per.select("event_type", "user_id", F.sum("n").over(Window.partitionBy("event_type").orderBy("user_id")).alias("running"))


query("running_counts", "SELECT event_type, user_id, CAST(sum(count(*)) OVER (PARTITION BY event_type ORDER BY user_id) AS BIGINT) AS running FROM events GROUP BY event_type, user_id")(_running)
