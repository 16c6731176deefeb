"""Registered queries of the raw layer: linked data, adapters, the cleaning pass, raw files.

Pages and payloads are composed by expressions from whole tables, so that SQL can say from the same
columns what has to come out.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import lens, sqlfunctions
from tidemark.catalog import ORACLES, _wilson_sql, query
from tidemark.functions import classify, dates, geo, text
from tidemark.lens import TITLES, read
from tidemark.operators.keyed import KeyedTable
from tidemark.plans import clean, quality, serving, views
from tidemark.shared import shared_folder, spread
from tidemark.sources import adapters, pages, raw_layer


def _filled(template: str, **values: Column) -> Column:
    """A text with the columns in place of their names in angle brackets."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit(f"<{name}>"), value.cast("string"))
    return out


# ---- linked data ----

POSTING = '{"@type": ["Thing", "<kind>"], "@id": "p", "title": "<title>", "hiringOrganization": {"@id": "o<n>"}, "jobLocation": [{"@id": "l"}], "datePublished": "2026-01-02"}'
EMPLOYERS = '[{"@id": "o<n>", "name": "a stub"}, [{"@graph": {"@id": "o<n>", "@type": "Organization", "name": "<name>", "address": {"@id": "a"}}}]]'
PLACES = '{"@graph": [{"@id": "l", "@type": "Place", "address": {"@id": "a"}}, {"@id": "a", "addressLocality": "<place>", "addressCountry": {"@id": "c"}}, {"@id": "c", "name": "a country", "of": {"@id": "a"}}]}'


@query(
    "linked_data",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS title, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS company, CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN n_name END AS locality,
 CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN 'a country' END AS country, CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN 'a' END AS beyond, '2026-01-02' AS published FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def linked_data(spark: SparkSession, d: str) -> DataFrame:
    """A posting under up to five graphs, its employer and place in other blocks, references over three
    steps and a circle of them; some blocks are broken, some pages have no posting."""
    k = F.col("c_custkey")
    kind = F.when(k % 5 == 0, "Article").otherwise("JobPosting")
    deep = (k % 6).cast("int")
    posting = F.concat(F.repeat(F.lit('{"@graph": ['), deep), _filled(POSTING, kind=kind, title=F.col("c_mktsegment"), n=F.col("n_nationkey")), F.repeat(F.lit("]}"), deep))
    places = F.when(k % 7 == 0, F.lit('{"@graph": [{"@id": "l"')).otherwise(_filled(PLACES, place=F.col("n_name")))
    blocks = F.array(_filled(EMPLOYERS, n=F.col("n_nationkey"), name=F.col("c_name")), posting, places)
    rows = _customers(spark, d).select(k.alias("page"), blocks.alias("blocks"))
    at = lambda path: F.try_variant_get(F.parse_json("posting"), path, "string")
    place = "$.jobLocation[0].address"
    return pages.linked_data(rows).select(
        F.col("page").alias("c_custkey"), at("$.title").alias("title"), at("$.hiringOrganization.name").alias("company"), at(f"{place}.addressLocality").alias("locality"),
        at(f"{place}.addressCountry.name").alias("country"), at(f"{place}.addressCountry.of['@id']").alias("beyond"), "published",
    )


# ---- rules as data ----

RANKS = ["Senior", "", "Assistant to the", "École", "Remote"]
JOBS = ["Data Engineer", "Fullstack Dev", "full-stack developer", "Nurse", "AGRONOMISTS", "Poet", "M&E Officer", "Accounts Clerk", "Databases", "Key Account Lead", "hr", "Storyteller"]
FIELDS = ["ICT", "Banking & Insurance", "Hotels", "Farming / forestry", "Charity", "Poetry"]


def _at(values: list[str], n: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), n.cast("int"))


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _rule_chain(column: str, which: int) -> str:
    return " ".join(f"WHEN regexp_matches({column}, '(?i)\\b({rule[which]})\\b') THEN '{rule[1]}'" for rule in classify.RULES if rule[which])


@query(
    "classify_rules",
    f"""WITH t AS (SELECT o_orderkey, {_sql_list(RANKS)}[o_orderkey % 5 + 1] || ' ' || {_sql_list(JOBS)}[o_custkey % 12 + 1] AS title, CASE WHEN o_orderkey % 7 <> 0 THEN {_sql_list(FIELDS)}[o_orderkey % 6 + 1] END AS industry FROM orders)
 SELECT o_orderkey, CASE {_rule_chain("title", 2)} {_rule_chain("coalesce(industry, '')", 3)} ELSE 'Other' END AS category FROM t""",
)
def classify_rules(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("o_orderkey")
    title = F.concat(_at(RANKS, n % 5), F.lit(" "), _at(JOBS, F.col("o_custkey") % 12))
    rows = read(spark, d, "orders").select("o_orderkey", title.alias("title"), F.when(n % 7 != 0, _at(FIELDS, n % 6)).alias("industry"))
    return classify.classify_by_table(rows, "title", "industry", classify.rules_table(spark)).select("o_orderkey", "category")


# ---- adapters: every order as a payload of each source ----

TOWNS = ["Nairobi", "Mombasa", "Kisumu", "Nakuru", "Embu"]


def _json(**members: str | Column) -> Column:
    """A JSON object of members that are JSON texts; one that is null is left out."""
    parts = [F.concat(F.lit(f'"{name.replace("__", "-")}": '), F.lit(m) if isinstance(m, str) else m) for name, m in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def _text(value: str | Column) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))


def _one_of(n: Column, *cases: str | Column | None) -> Column:
    """The case whose number n is; null where that is None."""
    out = F.lit(None).cast("string")
    for i, case in enumerate(cases):
        if case is not None:
            out = F.when(n == i, F.lit(case) if isinstance(case, str) else case).otherwise(out)
    return out


def told(orders: DataFrame) -> DataFrame:
    """Orders with the words that their payloads are made of, each a column: payloads name them many times."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return orders.select(
        "*", _text(_at(TITLES, k % 7)).alias("title"), _at(TOWNS, c % 5).alias("town"), _text(F.concat(F.lit("Firm "), c)).alias("firm"), _text(F.col("o_orderdate").cast("string")).alias("day"),
        _text(F.concat(F.lit("https://x.example/"), k)).alias("link"), (c + 1).cast("string").alias("amount"), _at(list(_SHAPES), k % 5).alias("of"),
    )


def payloads() -> dict[str, Column]:
    """JSON of an order as each source would send it, in all the shapes that the source has."""
    k = F.col("o_orderkey")
    title, town, firm, day, link, amount = map(F.col, ["title", "town", "firm", "day", "link", "amount"])
    named = lambda *names: F.concat(F.lit("["), F.concat_ws(", ", *[_json(name=_text(n)) for n in names]), F.lit("]"))
    region = F.concat(F.lit("R"), k % 3)
    where = _one_of(
        k % 4, _text(town), _json(address=_text(F.concat(town, F.lit(", Kenya")))), F.concat(F.lit("["), _json(address=_json(streetAddress=_text(""), addressLocality=_text(town), addressRegion=_text(region))), F.lit(', "Kenya"]')), _json(addressRegion=_text(town)),
    )
    pay = _one_of(
        k % 5, _json(currency=_text("KES"), value=_json(minValue=amount, maxValue=F.concat(amount, F.lit("0")), unitText=_text("MONTH"))), _json(currency=_text("KES"), value=amount),
        _json(currency=_text("USD"), value=_json(value=_text(amount))), None, _text("12000"),
    )
    posting = dict(
        title=title, hiringOrganization=_one_of(k % 4, firm, _json(name=firm), F.concat(F.lit("["), _json(name=firm), F.lit(', {"name": "other"}]'))), jobLocation=where, jobLocationType=_one_of(k % 11, _text("telecommute")),
        datePosted=day, employmentType=_one_of(k % 2, '["FULL_TIME", "PART_TIME"]', '"CONTRACTOR"'), industry=_one_of(k % 2, '"Trade"'), occupationalCategory='["A", "B"]', description=_text("<p>Do the work</p>"),
        skills=_one_of(k % 3, '["Python", "SQL"]', '"Excel"'), baseSalary=pay, salaryText=_text("KES 5,000"),
    )
    headline = F.when(k % 3 == 2, _json(og_title=_text(F.concat(F.upper(_at(TITLES, k % 7)), F.lit(" IN "), town))))
    schema_org = F.when(k % 3 == 0, _json(url=link, **posting)).otherwise(_json(url=link, job_posting=_json(**posting, url='"not this one"'), page_meta=headline))
    reliefweb = _json(url=_one_of(k % 2, link), job=_json(
        title=title, url=link, source=F.concat(F.lit("["), _json(name=firm), F.lit(', {"id": 1}]')), city=_one_of(k % 3, named(town, "Thika"), "[]"), country=named("Kenya", "Uganda"), date=_json(created=day, closing=day),
        type=named("Job"), career_categories=named("Aid", "Health"), body__html=_text("<p>Help</p>"),
    ))
    pay_currency = _one_of(k % 5, _text("EUR"), None, None, None, _text("KES"))
    jsearch = _json(
        job=_json(
            job_title=title, employer_name=firm, job_apply_link=_one_of(k % 2, link), job_location=_one_of(k % 3, _text(town)), job_city=_text(town), job_country=_one_of(k % 2, _text("KE")), job_posted_at_datetime_utc=day,
            job_employment_type=_text("FULLTIME"), job_description=_text("Text"), job_salary_currency=pay_currency, job_min_salary=F.when(k % 5 < 4, amount), job_salary_string=_one_of(k % 5, None, _text("KSh 5,000 a month"), _text("about $70"), _text("well paid")),
            job_is_remote=_one_of(k % 4, "true", "false"), required_technologies=_one_of(k % 2, '["Go", "SQL"]'),
        ),
        observed=_json(job_title='"an older title"', job_google_link=link, job_salary_period='"month"', job_function='"Trade"'),
    )
    jooble = _json(job=_json(link=link, title=title, company=firm, location=_text(town), updated=day, type=_text("Full-time"), snippet=_text("a snippet"), salary=_one_of(k % 2, '"KES 5,000"', '""')))
    remotive = _json(job=_json(
        url=link, title=title, company_name=firm, candidate_required_location=_text(town), publication_date=day, job_type=_text("contract"), category=_text("Data"), description=_text("Remote work"),
        tags=_one_of(k % 2, '["python", "sql"]', "[]"), salary=_text("$5"),
    ))
    return {"myjobmag": schema_org, "reliefweb": reliefweb, "jsearch": jsearch, "jooble": jooble, "remotive": remotive}


#: The columns of each source in SQL; what is not named is null, or false, or an empty text of skills.
_ROW = f"""SELECT o_orderkey AS k, o_custkey AS c, {_sql_list(TITLES)}[o_orderkey % 7 + 1] AS title, 'Firm ' || o_custkey AS firm, {_sql_list(TOWNS)}[o_custkey % 5 + 1] AS town, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day,
 'https://x.example/' || o_orderkey AS link, CAST(o_custkey + 1 AS VARCHAR) AS amount FROM orders"""
_LISTED = "CASE k % 4 WHEN 1 THEN town || ', Kenya' WHEN 2 THEN town || ', R' || k % 3 || ', Kenya' ELSE town END"
_SHAPES = {
    "myjobmag": {
        "url": "link", "company": "CASE WHEN k % 4 < 3 THEN firm END", "location_text": f"CASE WHEN k % 3 = 2 AND k % 4 NOT IN (0, 3) THEN town || ', ' || {_LISTED} ELSE {_LISTED} END", "remote_hint": "k % 11 = 0", "date_posted": "day",
        "employment_type": "CASE k % 2 WHEN 0 THEN 'FULL_TIME, PART_TIME' ELSE 'CONTRACTOR' END", "industry": "CASE k % 2 WHEN 0 THEN 'Trade' ELSE 'A, B' END", "description_html": "'<p>Do the work</p>'",
        "skills_text": "CASE k % 3 WHEN 0 THEN 'Python, SQL' WHEN 1 THEN 'Excel' ELSE '' END", "base_currency": "CASE k % 5 WHEN 0 THEN 'KES' WHEN 1 THEN 'KES' WHEN 2 THEN 'USD' END", "base_low": "CASE WHEN k % 5 = 0 THEN amount END",
        "base_high": "CASE WHEN k % 5 = 0 THEN amount || '0' END", "base_single": "CASE WHEN k % 5 IN (1, 2) THEN amount END", "base_unit": "CASE WHEN k % 5 = 0 THEN 'MONTH' END", "salary_text": "'KES 5,000'",
    },
    "reliefweb": {
        "url": "link", "company": "firm", "location_text": "CASE WHEN k % 3 = 0 THEN town || ', Thika' ELSE 'Kenya, Uganda' END", "date_posted": "day", "valid_through": "day", "employment_type": "'Job'", "industry": "'Aid, Health'", "description_html": "'<p>Help</p>'",
    },
    "jsearch": {
        "url": "link", "company": "firm", "location_text": "CASE WHEN k % 3 = 0 OR k % 2 = 1 THEN town ELSE town || ', KE' END", "remote_hint": "k % 4 = 0", "date_posted": "day", "employment_type": "'FULLTIME'", "industry": "'Trade'", "description_html": "'Text'",
        "skills_text": "CASE k % 2 WHEN 0 THEN 'Go, SQL' ELSE '' END", "base_currency": "CASE k % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'KES' WHEN 2 THEN 'USD' END", "base_low": "CASE WHEN k % 5 < 3 THEN amount END", "base_unit": "CASE WHEN k % 5 < 3 THEN 'MONTH' END",
    },
    "jooble": {"url": "link", "company": "firm", "location_text": "town", "date_posted": "day", "employment_type": "'Full-time'", "description_html": "'a snippet'", "salary_text": "CASE WHEN k % 2 = 0 THEN 'KES 5,000' END"},
    "remotive": {
        "url": "link", "company": "firm", "location_text": "town", "remote_hint": "TRUE", "date_posted": "day", "employment_type": "'contract'", "industry": "'Data'", "description_html": "'Remote work'", "skills_text": "CASE k % 2 WHEN 0 THEN 'python, sql' ELSE '' END", "salary_text": "'$5'",
    },
}


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return spread(read(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate")))


def _adapter(source: str) -> None:
    default = {"title": "title", "remote_hint": "FALSE", "skills_text": "''"}
    columns = ", ".join(f"{(default | _SHAPES[source]).get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in adapters.COMMON)

    @query(f"adapter_{source}", f"SELECT k AS o_orderkey, {columns} FROM ({_ROW})")
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = told(_orders(spark, d)).select("o_orderkey", F.lit(source).alias("source"), F.parse_json(payloads()[source]).alias("payload"))
        return adapters.adapt(rows).select("o_orderkey", *adapters.COMMON)


for _source in _SHAPES:
    _adapter(_source)


def posted(spark: SparkSession, d: str) -> DataFrame:
    """Each order as the latest version of a posting, from one source in turn."""
    k = F.col("o_orderkey")
    source = F.col("of")
    payload = F.lit(None).cast("string")
    for name, json in payloads().items():
        payload = F.when(source == name, json).otherwise(payload)
    rows = told(_orders(spark, d)).select(k.alias("id"), source.alias("source"), k.cast("string").alias("job_key"), payload.alias("json"), F.col("o_orderdate").cast("timestamp").alias("first_seen"))
    return rows.select("id", "source", "job_key", F.parse_json("json").alias("payload"), "first_seen", F.col("first_seen").alias("last_seen"))


_COUNTIES = {t: geo.county_names().index(t) + 1 for t in TOWNS}
_CODE = "CASE county " + " ".join(f"WHEN '{t}' THEN {n}" for t, n in _COUNTIES.items()) + " END"


@query(
    "clean_postings",
    f"""WITH r AS ({_ROW}), s AS (SELECT *, {_sql_list(list(_SHAPES))}[k % 5 + 1] AS source FROM r),
 t AS (SELECT *, CASE WHEN source = 'reliefweb' AND k % 3 <> 0 THEN NULL ELSE town END AS county, CASE WHEN source = 'myjobmag' AND k % 4 = 3 THEN NULL ELSE firm END AS company,
   lower(regexp_replace(title, '[^A-Za-z0-9]+', ' ', 'g')) AS title_norm, trim(lower(regexp_replace(firm, '[^A-Za-z0-9]+', ' ', 'g'))) AS firm_norm FROM s),
 u AS (SELECT *, {_CODE} AS county_code FROM t)
 SELECT source, CAST(k AS VARCHAR) AS job_key, title AS title_clean, title_norm, company, county, county_code, CASE WHEN title LIKE 'Senior %' THEN 'senior' ELSE 'unspecified' END AS seniority, CAST(day AS DATE) AS date_posted,
   source = 'remotive' OR (source = 'myjobmag' AND k % 11 = 0) OR (source = 'jsearch' AND k % 4 = 0) AS is_remote, CASE source WHEN 'myjobmag' THEN 'Do the work' WHEN 'reliefweb' THEN 'Help' WHEN 'jsearch' THEN 'Text' WHEN 'jooble' THEN 'a snippet' ELSE 'Remote work' END AS description_text,
   CASE WHEN company IS NOT NULL THEN sha1(title_norm || '|' || firm_norm || '|' || coalesce(CAST(county_code AS VARCHAR), '')) END AS dedup_key FROM u""",
)
def clean_postings(spark: SparkSession, d: str) -> DataFrame:
    """The cleaning pass over postings of all sources."""
    columns = ["source", "job_key", "title_clean", "title_norm", "company", "county", "county_code", "seniority", "date_posted", "is_remote", "description_text", "dedup_key"]
    return clean.clean(posted(spark, d)).select(*columns)


# ---- functions in SQL texts ----


def curves_in_sql(spark: SparkSession, observed: DataFrame) -> DataFrame:
    """Curves of observations that are counted into arrays. The row that LATERAL takes is worked out
    twice and joined with itself, so its arrays are sorted: collected as they come, the two may differ."""
    sqlfunctions.register(spark)
    return spark.sql(
        """WITH counted AS (SELECT source, duration_days, left_listing, count(*) AS n FROM {observed} GROUP BY ALL),
 arrays AS (SELECT source, sort_array(collect_list(struct(duration_days, left_listing, n))) AS x FROM counted GROUP BY source)
 SELECT source, k.t AS age_days, k.at_risk, k.n_events, round(k.survival, 4) AS survival FROM arrays, LATERAL km_survival_counted(x.duration_days, x.left_listing, x.n) AS k""",
        observed=observed,
    )


@query("lifetime_km_sql", ORACLES["lifetime_km"])
def lifetime_km_sql(spark: SparkSession, d: str) -> DataFrame:
    """The curves of ``lifetime_km``, said in SQL."""
    t = lens.tables(spark, d)
    return curves_in_sql(spark, views.lifetime_observations(views.analytics_base(t), t["sightings"]))


@query(
    "sql_functions",
    f"""WITH t AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, {_sql_list(JOBS)}[o_custkey % 12 + 1] AS title, {_sql_list(FIELDS)}[o_orderkey % 6 + 1] AS industry FROM orders)
 SELECT o_orderkey, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS day_key, CASE {_rule_chain("title", 2)} {_rule_chain("industry", 3)} ELSE 'Other' END AS category,
   CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE {_wilson_sql("(o_custkey % 3)", "(o_custkey % 7)", "-")} END AS low, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE {_wilson_sql("(o_custkey % 3)", "(o_custkey % 7)", "+")} END AS high
 FROM t WHERE o_custkey % 3 <= o_custkey % 7""",
)
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """Date keys, categories and intervals, said in SQL."""
    sqlfunctions.register(spark)
    rows = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), _at(JOBS, F.col("o_custkey") % 12).alias("title"), _at(FIELDS, F.col("o_orderkey") % 6).alias("industry"))
    return spark.sql(
        """SELECT o_orderkey, date_key(day) AS day_key, classify_category(title, industry) AS category,
 CAST(round(CAST(100 * wilson_low(o_custkey % 3, o_custkey % 7) AS DECIMAL(38, 9)), 1) AS DOUBLE) AS low, CAST(round(CAST(100 * wilson_high(o_custkey % 3, o_custkey % 7) AS DECIMAL(38, 9)), 1) AS DOUBLE) AS high
 FROM {rows} WHERE o_custkey % 3 <= o_custkey % 7""",
        rows=rows,
    )


# ---- raw files, keys, hashes ----

_KEYED = "CASE o_orderkey % 3 WHEN 0 THEN 'https://x.example/' || o_orderkey WHEN 1 THEN 'v' || o_orderkey"
_STABLE = """'[{"k":"b","v":"\\"' || o_orderpriority || '\\""}' || CASE o_orderkey % 3 WHEN 1 THEN ',{"k":"identifier","v":"{\\"value\\":\\"v' || o_orderkey || '\\"}"}' ELSE '' END
 || ',{"k":"o","v":"' || o_custkey || '"}' || CASE o_orderkey % 3 WHEN 0 THEN ',{"k":"url","v":"\\"https://x.example/' || o_orderkey || '\\""}' ELSE '' END || ']'"""


def _envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Orders as one visit's payloads, in envelopes; every visit writes its time into them."""
    k = F.col("o_orderkey")
    payload = _json(
        o=F.col("o_custkey").cast("string"), fetched_at=_text(F.col("o_orderdate")), url=F.when(k % 3 == 0, _text(F.concat(F.lit("https://x.example/"), k))),
        identifier=F.when(k % 3 == 1, _json(value=_text(F.concat(F.lit("v"), k)))), observed=_text(k), b=_text(F.col("o_orderpriority")),
    )
    rows = read(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", F.parse_json(payload).alias("payload"))
    own = F.col("payload")
    return rows.select("o_orderkey", F.col("o_orderpriority").alias("source"), F.date_trunc("year", F.to_date("o_orderdate")).alias("scraped_at"), raw_layer.job_key(own).alias("job_key"), raw_layer.content_hash(own).alias("content_hash"), F.lit("run").alias("run_id"), "payload")


@query("raw_envelopes", f"WITH h AS (SELECT o_orderkey, sha256({_STABLE}) AS content_hash, {_KEYED} END AS named FROM orders) SELECT o_orderkey, coalesce(named, left(content_hash, 32)) AS job_key, content_hash FROM h")
def raw_envelopes(spark: SparkSession, d: str) -> DataFrame:
    return _envelopes(spark, d).select("o_orderkey", "job_key", "content_hash")


@query(
    "raw_files",
    f"""WITH h AS (SELECT o_orderkey, o_orderpriority, year(CAST(o_orderdate AS DATE)) AS y, sha256({_STABLE}) AS content_hash, {_KEYED} END AS named, o_custkey FROM orders)
 SELECT coalesce(named, left(content_hash, 32)) AS job_key, content_hash, CAST(o_custkey AS BIGINT) AS o, CAST(y AS INTEGER) AS y FROM h WHERE o_orderpriority = '2-HIGH' AND y BETWEEN 1994 AND 1996""",
)
def raw_files(spark: SparkSession, d: str) -> DataFrame:
    """All envelopes written as gzip files by source and day, one source and some days of them reread."""
    root = f"{shared_folder(spark)}/raw-files-{uuid.uuid4().hex}"
    raw_layer.write_batch(_envelopes(spark, d).drop("o_orderkey"), root)
    back = raw_layer.read_batches(spark, root, "2-HIGH", "1994-01-01", "1996-12-31")
    return back.select("job_key", "content_hash", F.try_variant_get("payload", "$.o", "long").alias("o"), F.year("scraped_at").alias("y"))


@query(
    "fingerprints",
    f"""WITH t AS (SELECT o_orderkey, 'Firm ' || o_custkey || ' Ltd.' AS e, {_sql_list(JOBS)}[o_custkey % 12 + 1] AS t, {_sql_list(FIELDS)}[o_orderkey % 6 + 1] AS p, {_sql_list(["Worldwide", "Nairobi, KENYA", "Lagos", "East Africa only", ""])}[o_orderkey % 5 + 1] AS place FROM orders),
 n AS (SELECT *, trim(lower(regexp_replace(e, '[^A-Za-z0-9]+', ' ', 'g'))) AS ne, trim(lower(regexp_replace(t, '[^A-Za-z0-9]+', ' ', 'g'))) AS nt, trim(lower(regexp_replace(p, '[^A-Za-z0-9]+', ' ', 'g'))) AS np FROM t)
 SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN left(sha1(ne || '|' || nt || '|' || np), 20) END AS fingerprint, regexp_matches(lower(place), 'kenya|africa|worldwide') AS open FROM n""",
)
def fingerprints(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    employer = F.when(k % 9 != 0, F.concat(F.lit("Firm "), F.col("o_custkey"), F.lit(" Ltd."))).otherwise(F.lit(" - "))
    place = _at(["Worldwide", "Nairobi, KENYA", "Lagos", "East Africa only", ""], k % 5)
    found = adapters.fingerprint(employer, _at(JOBS, F.col("o_custkey") % 12), _at(FIELDS, k % 6))
    return read(spark, d, "orders").select("o_orderkey", found.alias("fingerprint"), adapters.open_to_region(place).alias("open"))


# ---- pages composed from customers ----


def _customers(spark: SparkSession, d: str) -> DataFrame:
    customers = spread(read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    return customers.join(F.broadcast(read(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))


LINKS = '<p><a href="/job/cook-<k>">1</a><a href=\'/job/cook-<k>#apply\'>2</a><a href="https://m.example/job/other-<n>">3</a><a href="/job/a/b">4</a><a href="https://b.example/job/x">5</a><a href="/2026/01/<n>/post-<k>/">6</a><a href="/2026/1/02/post">7</a><a href="/job/q?x=1">8</a>'


@query("job_links", "SELECT c_custkey, 'https://m.example/job/cook-' || c_custkey || ' https://m.example/job/other-' || (10 + c_custkey % 20) AS jobs, 'https://m.example/2026/01/' || (10 + c_custkey % 20) || '/post-' || c_custkey || '/' AS posts FROM customer")
def job_links(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    html = _filled(LINKS, k=k, n=10 + k % 20)
    found = lambda path: F.array_join(pages.links(html, "https://m.example/", path), " ")
    return read(spark, d, "customer").select("c_custkey", found(pages.JOB_PATH).alias("jobs"), found(pages.POST_PATH).alias("posts"))


LABELLED = """<html><head><title> A page </title></head><body><h1><job> at <firm></h1><a href="/jobs-at/x">View Jobs at <firm></a><span>Posted: Sep <day>, 2026</span><ul><li><b>Job Type</b><i>Full Time</i></li><li>Location</li>
<li><a href="/jobs-location/a"><place></a></li><li>Job Field</li><li><a href="/jobs-by-field/b">Trade</a></li></ul><p>Check how your CV does</p><p>Sell <place> things.</p><script>no()</script><h3>Method of Application</h3><p>Mail us</p></body></html>"""
ARTICLE = """<html><head><script type="application/ld+json">{"@graph": [{"@type": "Article", "datePublished": "2026-02-<day>"}]}</script></head><body><nav>menu</nav><article><h1><day> Vacancies Open At <firm> – September 2026</h1>
<p>Location: <place> Employment Type: Full time Application Deadline: <day> March 2026</p></article></body></html>"""


def _record(spark: SparkSession, d: str, template: str, style: str) -> tuple[DataFrame, object]:
    day = F.lpad((10 + F.col("c_custkey") % 18).cast("string"), 2, "0")
    html = _filled(template, job=_at(TITLES, F.col("c_custkey") % 7), firm=F.col("c_name"), day=day, place=F.col("n_name"))
    rows = _customers(spark, d).select("c_custkey", F.concat(F.lit("https://x.example/"), "c_custkey").alias("url"), html.alias("html"))
    return pages.page_records(rows, style=style), lambda path, kind="string": F.try_variant_get("record", path, kind)


@query(
    "labelled_pages",
    f"""SELECT c_custkey, 'https://x.example/' || c_custkey AS url, 'A page' AS page, {_sql_list(TITLES)}[c_custkey % 7 + 1] AS title, c_name AS company, n_name AS place, '2026-09-' || (10 + c_custkey % 18) AS posted, 'Full Time' AS kind, 'Trade' AS field,
 'Sell ' || n_name || ' things.' AS description FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def labelled_pages(spark: SparkSession, d: str) -> DataFrame:
    found, at = _record(spark, d, LABELLED, "labelled")
    p = "$.job_posting"
    return found.select(
        "c_custkey", at("$.url").alias("url"), at("$.page_meta.html_title").alias("page"), at(f"{p}.title").alias("title"), at(f"{p}.hiringOrganization.name").alias("company"), at(f"{p}.jobLocation.address.addressLocality").alias("place"),
        at(f"{p}.datePosted").alias("posted"), at(f"{p}.employmentType").alias("kind"), at(f"{p}.industry").alias("field"), at(f"{p}.description").alias("description"),
    )


@query(
    "article_pages",
    """SELECT c_custkey, c_name AS company, n_name AS place, '2026-02-' || (10 + c_custkey % 18) AS posted, '2026-03-' || (10 + c_custkey % 18) AS due, CAST(10 + c_custkey % 18 AS INTEGER) AS vacancies, TRUE AS roundup FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def article_pages(spark: SparkSession, d: str) -> DataFrame:
    found, at = _record(spark, d, ARTICLE, "article")
    p = "$.job_posting"
    return found.select(
        "c_custkey", at(f"{p}.hiringOrganization.name").alias("company"), at(f"{p}.jobLocation.address.addressLocality").alias("place"), at(f"{p}.datePosted").alias("posted"), at(f"{p}.validThrough").alias("due"),
        at("$.vacancy_count", "int").alias("vacancies"), at("$.is_roundup", "boolean").alias("roundup"),
    )


@query("page_text", "SELECT c_custkey, 'We pay ' || printf('%,d', 1000 + c_custkey) || ' at A & B ' || n_name AS text, c_custkey % 2 = 0 AS visible FROM customer JOIN nation ON c_nationkey = n_nationkey")
def page_text(spark: SparkSession, d: str) -> DataFrame:
    """Text of HTML that is escaped once more, and whether a salary stands in it."""
    k = F.col("c_custkey")
    html = _filled("<div><p>We pay\n <b><pay></b></p><style>p {}</style>at A &amp;amp; B<br>&lt;i&gt;<place>&lt;/i&gt;<script>9</script></div>", pay=F.format_number(1000 + k, 0), place=F.col("n_name"))
    rows = _customers(spark, d).select("c_custkey", html.alias("html"), F.when(k % 2 == 0, 1000 + k).otherwise(7_000_000 + k).alias("amount"))
    return rows.select("c_custkey", text.html_to_text(F.col("html")).alias("text"), pages.salary_is_visible(F.col("html"), F.col("amount")).alias("visible"))


# ---- checks and charts ----


@query(
    "dq_run",
    """SELECT 'raw.orders.o_custkey.not_null' AS name, count(*) FILTER (o_custkey IS NULL) AS violations, count(*) AS total, count(*) FILTER (o_custkey IS NULL) = 0 AS passed FROM orders
 UNION ALL SELECT 'raw.orders.o_orderpriority.accepted_values', count(*) FILTER (o_orderpriority <> '1-URGENT'), count(*), FALSE FROM orders
 UNION ALL SELECT 'raw.orders.dear', count(*) FILTER (NOT o_totalprice < 200000), count(*), count(*) FILTER (NOT o_totalprice < 200000) <= 0.9 * count(*) FROM orders
 UNION ALL SELECT 'raw.orders.no_such_column', 0, 0, FALSE
 UNION ALL SELECT 'raw.orders.o_custkey.relationships', count(*) FILTER (c_custkey IS NULL), count(*), count(*) FILTER (c_custkey IS NULL) = 0 FROM orders LEFT JOIN customer ON o_custkey = c_custkey
 UNION ALL SELECT 'ops.click.seen_within_3d', CASE WHEN max(CAST(ts + INTERVAL 3 HOUR AS DATE)) < DATE '2024-01-25' - 3 THEN 1 ELSE 0 END, 1, max(CAST(ts + INTERVAL 3 HOUR AS DATE)) >= DATE '2024-01-25' - 3 FROM events WHERE event_type = 'click'
 UNION ALL SELECT 'ops.nobody.seen_within_3d', 1, 1, FALSE
 UNION ALL SELECT 'raw.orders_match_customers', abs((SELECT count(*) FROM orders) - (SELECT count(*) FROM customer)), (SELECT count(*) FROM customer), abs((SELECT count(*) FROM orders) - (SELECT count(*) FROM customer)) <= 20 * (SELECT count(*) FROM customer)""",
)
def dq_run(spark: SparkSession, d: str) -> DataFrame:
    """Checks of every kind, run as a suite; one of them cannot run."""
    as_of = date(2024, 1, 25)
    seen = read(spark, d, "events").select(F.col("event_type").alias("source"), dates.local_date(F.col("ts").cast("timestamp")).alias("seen_on"))
    tables = {"raw.orders": read(spark, d, "orders"), "raw.customer": read(spark, d, "customer"), "raw.sightings": seen}
    count = lambda t, name: t[name].agg(F.count(F.lit(1)).alias("n"))
    apart = lambda t: count(t, "raw.orders").join(count(t, "raw.customer").withColumnRenamed("n", "total")).select(F.abs(F.col("n") - F.col("total")).alias("violations"), "total")  # noqa: E731  a row each
    checks = [
        quality.not_null("raw.orders", "o_custkey"), quality.accepted_values("raw.orders", "o_orderpriority", ["1-URGENT"]), quality.expression_is_true("raw.orders", "o_totalprice < 200000", "dear", max_fraction=0.9),
        quality.expression_is_true("raw.orders", "no_such > 1", "no_such_column"), quality.relationships("raw.orders", "o_custkey", "raw.customer", "c_custkey"), quality.seen_recently("click", as_of), quality.seen_recently("nobody", as_of),
        quality.custom("raw.orders_match_customers", "raw", apart, max_fraction=20.0),
    ]
    results = quality.run_checks(checks, tables)
    return quality.results_frame(spark, results, datetime(2024, 1, 25, tzinfo=timezone.utc)).select(F.col("check_name").alias("name"), "violations", "total", "passed")


@query("skill_chart", f"SELECT * FROM ({ORACLES['skill_demand_grid']}) ORDER BY balanced_pct DESC, postings DESC, skill_name LIMIT 15")
def skill_chart(spark: SparkSession, d: str) -> DataFrame:
    t = lens.tables(spark, d)
    return serving.skill_chart(views.skill_demand(views.analytics_base(t), t["dim_skill"]), balanced=True)


@query(
    "clean_profile",
    f"""WITH r AS ({_ROW}), s AS (SELECT *, {_sql_list(list(_SHAPES))}[k % 5 + 1] AS source FROM r) SELECT count(*) AS postings, count(*) FILTER (NOT (source = 'myjobmag' AND k % 4 = 3)) AS company, count(*) AS date_posted,
 count(*) FILTER (NOT (source = 'reliefweb' AND k % 3 <> 0)) AS county, count(*) FILTER (NOT (source = 'myjobmag' AND k % 4 = 3)) AS dedup_key, count(*) FILTER (source = 'remotive' OR (source = 'myjobmag' AND k % 11 = 0) OR (source = 'jsearch' AND k % 4 = 0)) AS remote FROM s""",
)
def clean_profile(spark: SparkSession, d: str) -> DataFrame:
    return clean.profile(clean.clean(posted(spark, d))).select("postings", "company", "date_posted", "county", "dedup_key", "remote")


# ---- incremental load ----


@query("keyed_upsert", "SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 10 = 0 AND o_orderpriority IN ('1-URGENT', '5-LOW') THEN -1 ELSE o_custkey END AS o_custkey FROM orders")
def keyed_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A table of all orders but some, and then a batch that changes and adds rows of two partitions."""
    k = F.col("o_orderkey")
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    name = f"keyed_{uuid.uuid4().hex}"
    table = KeyedTable.create(spark, name, orders, ["o_orderpriority", "o_orderkey"], "o_orderpriority", f"{shared_folder(spark)}/{name}", buckets=8)
    two = F.col("o_orderpriority").isin("1-URGENT", "5-LOW")
    table.insert_ignore(orders.filter(~two | (k % 20 != 0)))
    table.upsert(orders.filter(two & (k % 10 == 0)).withColumn("o_custkey", F.lit(-1).cast("long")))
    return table.read().select("o_orderkey", "o_orderpriority", "o_custkey")
