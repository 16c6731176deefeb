"""Registered queries of the cleaning functions, merging and the warehouse load.

Inputs are composed by expressions from whole tables, so that SQL can say from the same columns
what has to come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.functions import geo, salary, skills, stats, text
from tidemark.lens import SHIFT_DAYS, TITLES, read
from tidemark.operators import merge
from tidemark.plans import warehouse
from tidemark.shared import dealt
from tidemark.sources import pages


def _choice(values: list[str], at: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), at.cast("int"))


def _sql(text_: str) -> str:
    return "'" + text_.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(map(_sql, values)) + "]"


# ---- titles, companies, dates ----

NOISE = ["URGENT: ", "Job Vacancy - ", "hiring: ", ""]
ENDINGS = [" - Nairobi", " (Urgent hiring)", ", Nairobi, Kenya", ""]


def _key() -> Column:
    return F.col("o_orderkey")



@query("clean_title", f"SELECT o_orderkey, {_list(TITLES)}[o_orderkey % 7 + 1] AS clean FROM orders")
def clean_title(spark: SparkSession, d: str) -> DataFrame:
    """Noise, places and shouting around a title go, whatever the combination."""
    title = F.when(F.floor(_key() / 112) % 2 == 0, F.upper(_choice(TITLES, _key() % 7))).otherwise(_choice(TITLES, _key() % 7))
    raw = F.concat(_choice(NOISE, F.floor(_key() / 7) % 4), title, _choice(ENDINGS, F.floor(_key() / 28) % 4))
    return read(spark, d, "orders").select("o_orderkey", text.clean_title(raw).alias("clean"))


WORDS = ["Senior", "Jr.", "Head of", "Intern,", "Mid-Level", "Chief Executive Officer of", "Graduate", "Vice President,", "Leading", "Internal"]
_LEVELS = " ".join(f"WHEN regexp_matches(norm, {_sql(pattern)}) THEN '{level}'" for level, pattern in text.LEVELS)


@query("seniority", f"SELECT o_orderkey, CASE {_LEVELS} ELSE 'unspecified' END AS level FROM (SELECT o_orderkey, trim(regexp_replace(lower({_list(WORDS)}[o_orderkey % 10 + 1] || ' ' || o_clerk), '[^a-z0-9]+', ' ', 'g')) AS norm FROM (SELECT o_orderkey, {_list(TITLES)}[o_orderkey % 7 + 1] AS o_clerk FROM orders))")
def seniority(spark: SparkSession, d: str) -> DataFrame:
    title = F.concat(_choice(WORDS, _key() % 10), F.lit(" "), _choice(TITLES, _key() % 7))
    return read(spark, d, "orders").select("o_orderkey", text.seniority(title).alias("level"))


FORMS = [" Ltd", " Limited", " PLC.", ""]


@query("company_norm", "SELECT c_custkey, c_name || ['', ' ', '  ', ' '][c_custkey % 4 + 1] AS padded, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) END AS norm FROM customer")
def company_norm(spark: SparkSession, d: str) -> DataFrame:
    at = F.col("c_custkey")
    name = F.when(at % 9 == 0, _choice(["Confidential Ltd", "Our Client", "undisclosed"], at % 3)).otherwise(F.concat("c_name", _choice(FORMS, at % 4)))
    return read(spark, d, "customer").select("c_custkey", F.concat("c_name", _choice(["", " ", "  ", " "], at % 4)).alias("padded"), text.company_norm(name).alias("norm"))


@query("clean_company", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name || ' & Sons' END AS company FROM customer")
def clean_company(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit("  "), "c_name", F.lit("  &amp;\n Sons ")))
    return read(spark, d, "customer").select("c_custkey", text.clean_company(name).alias("company"))


@query("parse_month_day", "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day FROM orders")
def parse_month_day(spark: SparkSession, d: str) -> DataFrame:
    said = F.concat(F.lit("Posted: "), F.date_format(F.to_date("o_orderdate"), "MMM d, yyyy"), F.lit(" by us"))
    return read(spark, d, "orders").select("o_orderkey", text.parse_month_day(said).alias("day"))


# ---- places ----

_COUNTY = f"{_list(geo.COUNTIES)}[c_custkey % 47 + 1]"


@query("map_location", f"SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE {_COUNTY} END AS county, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 47 + 1 AS INTEGER) END AS county_code, c_custkey % 5 = 0 AS is_remote FROM customer")
def map_location(spark: SparkSession, d: str) -> DataFrame:
    at = F.col("c_custkey")
    named = F.concat(_choice(["", "Kenya, ", "Floor 3 / "], at % 3), F.upper(_choice(geo.COUNTIES, at % 47)), _choice([" County", " Town", ""], at % 3))
    place = F.concat(F.when(at % 5 == 0, "Remote - ").otherwise(""), F.when(at % 11 == 0, F.lit("Berlin")).otherwise(named))
    return read(spark, d, "customer").select("c_custkey", geo.map_location(place).alias("x")).select("c_custkey", "x.*")


@query("location_only", "SELECT c_custkey, c_custkey % 3 <> 0 AS only_place FROM customer")
def location_only(spark: SparkSession, d: str) -> DataFrame:
    at = F.col("c_custkey")
    place = F.concat(_choice(geo.COUNTIES, at % 47), _choice([" office", ", Kenya", " County / Kenya"], at % 3))
    return read(spark, d, "customer").select("c_custkey", geo.is_location_only(place).alias("only_place"))


# ---- salaries ----

PERIOD_WORDS = ["per month", "per annum", "daily", "hourly", "weekly"]
PERIOD_NAMES = ["month", "year", "day", "hour", "week"]
_MONTHS = "[1.0::DOUBLE, 1.0::DOUBLE / 12, 22.0::DOUBLE, 176.0::DOUBLE, 52.0::DOUBLE / 12][o_orderkey % 5 + 1]"
_AMOUNTS = f"SELECT o_orderkey, floor(o_totalprice)::DOUBLE AS low, floor(o_totalprice)::DOUBLE + 1500 AS high, {_list(PERIOD_NAMES)}[o_orderkey % 5 + 1] AS period, {_MONTHS} AS factor, o_orderkey % 7 = 0 AS open FROM orders"
_SOUND = "NOT open AND low * factor BETWEEN 5000 AND 3000000 AND high * factor <= 5000000"


@query("salary_text", f"SELECT o_orderkey, CASE WHEN {_SOUND} THEN low END AS low, CASE WHEN {_SOUND} THEN high END AS high, CASE WHEN {_SOUND} THEN period END AS period FROM ({_AMOUNTS})")
def salary_text(spark: SparkSession, d: str) -> DataFrame:
    """Ranges in text; an open end (``up to``) is no salary."""
    low = F.floor(F.col("o_totalprice").cast("double"))
    told = F.concat(F.lit("We pay KSh "), F.format_number(low.cast("double"), 0), F.lit(" - "), F.format_number((low + 1500).cast("double"), 0), F.lit(" "), _choice(PERIOD_WORDS, _key() % 5), F.lit(", free lunch"))
    capped = F.concat(F.lit("earn up to KES "), F.format_number(low.cast("double"), 0), F.lit(" monthly"))
    found = salary.from_text(F.when(_key() % 7 == 0, capped).otherwise(told))
    return read(spark, d, "orders").select("o_orderkey", found.alias("x")).select("o_orderkey", F.col("x.min").alias("low"), F.col("x.max").alias("high"), F.col("x.period").alias("period"))


@query("salary_structured", f"SELECT o_orderkey, CASE WHEN {_SOUND} THEN low END AS low, CASE WHEN {_SOUND} THEN high END AS high, CASE WHEN {_SOUND} THEN round(low * factor, 2) END AS monthly FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN low ELSE high END AS high, FALSE AS open) FROM ({_AMOUNTS}))")
def salary_structured(spark: SparkSession, d: str) -> DataFrame:
    """Both bounds, in either order, or a single value."""
    low = F.floor(F.col("o_totalprice").cast("double")).cast("double")
    single, pair = _key() % 3 == 0, _key() % 3 != 0
    swapped = _key() % 2 == 0
    lo, hi = F.when(pair, F.when(swapped, low + 1500).otherwise(low)), F.when(pair, F.when(swapped, low).otherwise(low + 1500))
    found = salary.from_structured(F.lit("kes"), lo.cast("string"), hi.cast("string"), F.when(single, low).cast("string"), _choice(["Month", "annum", "DAY", "hour", "WEEK"], _key() % 5))
    return read(spark, d, "orders").select("o_orderkey", found.alias("x")).select("o_orderkey", F.col("x.min").alias("low"), F.col("x.max").alias("high"), F.round("x.min_monthly_kes", 2).alias("monthly"))


# ---- skills ----


def _skill_rules() -> str:
    """(place in the dictionary, name, pattern in any case, pattern in its own case) in SQL."""
    sides = lambda aliases, before, after: _sql(f"(^|{before})({'|'.join(map(skills.literal, aliases))})($|{after})") if aliases else "NULL"
    rows = [f"({k}, {_sql(s.name)}, {sides(s.aliases, '[^a-z0-9+#.]', '[^a-z0-9+#]')}, {sides(s.exact, '[^A-Za-z0-9+#.]', '[^A-Za-z0-9+#]')})" for k, s in enumerate(skills.SKILLS)]
    return ", ".join(rows)


HINTS = [a for s in skills.SKILLS for a in (*s.aliases, *s.exact)]


@query(
    "skill_dictionary",
    f"""WITH d AS (SELECT doc_id, regexp_replace(text || ' ' || {_list(HINTS)}[doc_id % {len(HINTS)} + 1] || '.', '[-_]', ' ', 'g') AS plain FROM documents WHERE text IS NOT NULL),
 found AS (SELECT doc_id, k, name FROM d, (VALUES {_skill_rules()}) r(k, name, any_case, in_case) WHERE coalesce(regexp_matches(lower(plain), any_case), FALSE) OR coalesce(regexp_matches(plain, in_case), FALSE))
 SELECT d.doc_id, coalesce((SELECT string_agg(name, ',' ORDER BY k) FROM found WHERE found.doc_id = d.doc_id), '') AS skills FROM d""",
)
def skill_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """The whole dictionary over whole texts, each with an alias of the dictionary at its end."""
    told = F.concat("text", F.lit(" "), _choice(HINTS, F.col("doc_id") % len(HINTS)), F.lit("."))
    found = F.array_join(F.transform(skills.extract_skills(told), lambda s: s["skill"]), ",")
    return read(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", found.alias("skills"))


# ---- pages ----


@query("page_links", r"SELECT page_id, coalesce(array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(html, '<a href=\"(/[A-Za-z]+)\"', 1), lambda p: 'https://m.example' || p))), ' '), '') AS links FROM pages")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    found = pages.links(F.col("html"), "https://m.example", "/[A-Za-z]+")
    return read(spark, d, "pages").select("page_id", F.array_join(F.array_sort(found), " ").alias("links"))


# ---- survival, merging ----


@query(
    "km_arrays",
    """WITH o AS (SELECT l_suppkey, CAST(l_quantity AS INTEGER) AS t, l_returnflag = 'R' AS e FROM lineitem), s AS (SELECT l_suppkey, t, count(*) AS c, count(*) FILTER (e) AS x FROM o GROUP BY ALL), r AS (SELECT *, sum(c) OVER (PARTITION BY l_suppkey ORDER BY t DESC) AS n FROM s)
 SELECT l_suppkey, t, CAST(n AS BIGINT) AS at_risk, x AS n_events FROM r""",
)
def km_arrays(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").select("l_suppkey", F.col("l_quantity").cast("int").alias("t"), (F.col("l_returnflag") == "R").alias("e"))
    listed = rows.groupBy("l_suppkey").agg(F.collect_list(F.struct("t", "e")).alias("x")).select("l_suppkey", "x.t", "x.e")
    return stats.km_arrays(listed, ["l_suppkey"], "t", "e").select("l_suppkey", "t", F.col("at_risk").cast("long").alias("at_risk"), F.col("n_events").cast("long").alias("n_events"))


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = read(spark, d, "orders")
    return o.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey", F.lit("old").alias("v")), o.filter("o_orderstatus <> 'O'").select("o_orderkey", "o_custkey", F.lit("new").alias("v"))


@query("upsert", "SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'old' ELSE 'new' END AS v FROM orders")
def upsert(spark: SparkSession, d: str) -> DataFrame:
    return merge.upsert(*_halves(spark, d), ["o_orderkey"])


@query("replace_groups", "SELECT o_orderkey, o_custkey, 'new' AS v FROM orders WHERE o_orderstatus <> 'O' UNION ALL SELECT o_orderkey, o_custkey, 'old' FROM orders WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'O')")
def replace_groups(spark: SparkSession, d: str) -> DataFrame:
    return merge.replace_groups(*_halves(spark, d), "o_custkey")


@query("drop_orphans", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def drop_orphans(spark: SparkSession, d: str) -> DataFrame:
    parents = read(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return merge.drop_orphans(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), parents, ["l_orderkey"])


# ---- warehouse load ----


def _load(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Clean postings out of orders, and their skills out of the parts they name."""
    o = read(spark, d, "orders").join(read(spark, d, "customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    posted = F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS)
    price = F.when(_key() % 3 == 0, F.col("o_totalprice").cast("decimal(14,2)"))
    postings = o.select(
        F.col("o_orderpriority").alias("source"), _key().cast("string").alias("job_key"), F.when(_key() % 10 != 0, F.col("c_name")).alias("company"), F.when(_key() % 10 != 0, F.lower("c_name")).alias("company_norm"),
        F.when(_key() % 6 != 0, (_key() % 47 + 1).cast("int")).alias("county_code"), F.when(_key() % 12 == 0, "Outside Kenya").otherwise("somewhere").alias("location_raw"), (_key() % 4 == 0).alias("is_remote"),
        posted.alias("date_posted"), F.date_add(posted, (_key() % 40).cast("int") - 5).alias("valid_through"), posted.cast("timestamp").alias("first_seen_at"), F.date_add(posted, 9).cast("timestamp").alias("last_seen_at"),
        F.lit("Cook").alias("title_clean"), F.lit("mid").alias("seniority"), F.lit(None).cast("string").alias("employment_type"), F.lit(None).cast("string").alias("industry"), F.lit("u").alias("url"), (F.col("o_orderstatus") == "P").alias("is_duplicate"),
        price.alias("salary_min_monthly_kes"), (price + 100).cast("decimal(14,2)").alias("salary_max_monthly_kes"), F.lit("text").alias("salary_source"),
    )
    items = read(spark, d, "lineitem").join(read(spark, d, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    items = dealt(items.select("l_orderkey", "p_type"), "l_orderkey")
    named = items.join(o.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == _key()).select(F.col("o_orderpriority").alias("source"), F.col("l_orderkey").cast("string").alias("job_key"), F.col("p_type").alias("skill"), F.substring("p_type", 1, 1).alias("category")).distinct()
    return warehouse.build(postings, named, warehouse.empty_registries(spark))


_DAY = f"(CAST(o_orderdate AS DATE) + {SHIFT_DAYS})"
_KEYS = lambda day: f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"
_UNTIL = f"({_DAY} + CAST(o_orderkey % 40 - 5 AS INTEGER))"
_PAIRS = "SELECT DISTINCT l_orderkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey"


@query(
    "warehouse_fact",
    f"""WITH n AS (SELECT l_orderkey, count(*) AS n FROM ({_PAIRS}) GROUP BY 1)
 SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS job_key, CASE WHEN o_orderkey % 10 = 0 THEN '(unknown)' ELSE lower(c_name) END AS company_norm,
 CAST(CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 47 + 1 WHEN o_orderkey % 12 = 0 THEN -3 WHEN o_orderkey % 4 = 0 THEN -2 ELSE -1 END AS INTEGER) AS location_key,
 {_KEYS(_DAY)} AS posted_date_key, {_KEYS(_UNTIL)} AS valid_through_date_key, {_KEYS(_DAY + ' + 9')} AS last_seen_date_key, o_orderkey % 3 = 0 AS has_salary,
 CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DECIMAL(14,2)) + 50 END::DOUBLE AS mid, CAST(coalesce(n, 0) AS INTEGER) AS skill_count, CASE WHEN o_orderkey % 40 >= 5 THEN CAST(o_orderkey % 40 - 5 AS INTEGER) END AS days_advertised
 FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN n ON l_orderkey = o_orderkey""",
)
def warehouse_fact(spark: SparkSession, d: str) -> DataFrame:
    t = _load(spark, d)
    return t["fact"].join(t["dim_company"], "company_key").select(
        "source", "job_key", "company_norm", F.col("location_key").cast("int").alias("location_key"), "posted_date_key", "valid_through_date_key", "last_seen_date_key", "has_salary", F.col("salary_mid_monthly_kes").cast("double").alias("mid"), "skill_count", "days_advertised"
    )


@query("warehouse_bridge", f"SELECT CAST(o_orderkey AS VARCHAR) AS job_key, p_type AS skill_name, substr(p_type, 1, 1) AS category FROM ({_PAIRS}) JOIN orders ON l_orderkey = o_orderkey")
def warehouse_bridge(spark: SparkSession, d: str) -> DataFrame:
    t = _load(spark, d)
    return t["bridge"].join(t["fact"].select("job_posting_key", "job_key"), "job_posting_key").join(t["dim_skill"], "skill_key").select("job_key", "skill_name", "category")


@query("warehouse_companies", "SELECT lower(c_name) AS company_norm, c_name AS company_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 10 <> 0) UNION ALL SELECT '(unknown)', 'Unknown / confidential'")
def warehouse_companies(spark: SparkSession, d: str) -> DataFrame:
    return _load(spark, d)["dim_company"].select("company_norm", "company_name")


@query("warehouse_locations", f"SELECT CAST(k AS INTEGER) AS location_key, county_name FROM (SELECT unnest(range(1, 48)) AS k, unnest({_list(geo.COUNTIES)}) AS county_name) UNION ALL VALUES (-1, 'Unknown'), (-2, 'Remote'), (-3, 'Outside Kenya')")
def warehouse_locations(spark: SparkSession, d: str) -> DataFrame:
    return warehouse.dim_location(spark).select("location_key", "county_name")
