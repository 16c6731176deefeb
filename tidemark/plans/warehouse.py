"""The star schema: dimensions with unknown members and stable keys, fact and bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, geo
from tidemark.operators import merge
from tidemark.shared import dealt

UNKNOWN, REMOTE, ABROAD = -1, -2, -3


def dim_date(spark: SparkSession) -> DataFrame:
    """Every day from 2000 to 2040, and the unknown day."""
    days = spark.sql("SELECT explode(sequence(DATE'2000-01-01', DATE'2040-12-31')) AS full_date")
    day = F.col("full_date")
    known = days.select(dates.date_key(day).alias("date_key"), day, *[c.alias(n) for n, c in dates.parts(day).items()])
    named = {"date_key": F.lit(UNKNOWN), "month_name": F.lit("Unknown"), "day_name": F.lit("Unknown")}
    return known.unionByName(spark.range(1).select(*[named.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in known.schema]))


def dim_location(spark: SparkSession) -> DataFrame:
    rows = [(k + 1, "county", k + 1, name) for k, name in enumerate(geo.county_names())]
    rows += [(UNKNOWN, "unknown", None, "Unknown"), (REMOTE, "remote", None, "Remote"), (ABROAD, "outside_kenya", None, "Outside Kenya")]
    return spark.createDataFrame(rows, "location_key int, location_type string, county_code int, county_name string")


def dim_company(postings: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Companies with the name they were last seen under; and the registry of their keys.
    registry: company_norm, company_key."""
    named = postings.filter("company_norm IS NOT NULL")
    seen, name = F.col("last_seen_at"), F.col("company")
    newest = F.struct(seen.isNull().alias("a"), (-F.unix_micros(seen)).alias("b"), name.isNull().alias("c"), name.alias("company"))
    last = named.groupBy("company_norm").agg(F.min(newest)["company"].alias("company_name"))
    keys = merge.register_keys(registry, named, "company_norm", "company_key")
    companies = keys.join(last, "company_norm").select("company_key", "company_norm", "company_name")
    unknown = postings.sparkSession.createDataFrame([(UNKNOWN, "(unknown)", "Unknown / confidential")], companies.schema)
    return companies.unionByName(unknown), keys


def dim_skill(job_skills: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Skills with their category; and the registry of their keys. registry: skill_name, skill_key."""
    named = job_skills.groupBy(F.col("skill").alias("skill_name")).agg(F.min("category").alias("category"))
    keys = merge.register_keys(registry, named, "skill_name", "skill_key")
    return keys.join(named, "skill_name").select("skill_key", "skill_name", "category"), keys


def location_key(county_code, location_raw, is_remote):
    """County before abroad before remote before unknown."""
    return F.when(county_code.isNotNull(), county_code).when(location_raw.ilike("%outside kenya%"), F.lit(ABROAD)).when(is_remote, F.lit(REMOTE)).otherwise(F.lit(UNKNOWN))


def _posting():
    """The business key of a posting as one text."""
    return F.to_json(F.struct("source", "job_key"))


def fact(postings: DataFrame, job_skills: DataFrame, companies: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per posting, duplicates flagged, with a stable key. registry: posting, job_posting_key."""
    named = postings.withColumn("posting", _posting())
    keys = merge.register_keys(registry, named, "posting", "job_posting_key")
    counted = job_skills.groupBy("source", "job_key").agg(F.count(F.lit(1)).alias("n"))
    known = companies.filter(F.col("company_key") != UNKNOWN).select("company_norm", "company_key")
    rows = named.join(keys, "posting").join(known, "company_norm", "left").join(counted, ["source", "job_key"], "left")
    low, high = F.col("salary_min_monthly_kes"), F.col("salary_max_monthly_kes")
    day = lambda c: dates.date_key(dates.local_date(F.col(c)))
    return rows.select(
        "job_posting_key", "source", "job_key",
        F.coalesce("company_key", F.lit(UNKNOWN)).alias("company_key"),
        location_key(F.col("county_code"), F.col("location_raw"), F.col("is_remote")).alias("location_key"),
        dates.date_key(F.col("date_posted")).alias("posted_date_key"),
        dates.date_key(F.col("valid_through")).alias("valid_through_date_key"),
        day("first_seen_at").alias("first_seen_date_key"),
        day("last_seen_at").alias("last_seen_date_key"),
        "title_clean", "seniority", "employment_type", "industry", "url", "is_remote", "is_duplicate",
        low.isNotNull().alias("has_salary"), low, high, ((low + high) / 2).cast("decimal(14,2)").alias("salary_mid_monthly_kes"), "salary_source",
        F.coalesce("n", F.lit(0)).cast("int").alias("skill_count"),
        F.when(F.col("valid_through") >= F.col("date_posted"), F.datediff("valid_through", "date_posted")).alias("days_advertised"),
    ), keys


def bridge(job_skills: DataFrame, postings: DataFrame, registry: DataFrame, skills: DataFrame) -> DataFrame:
    """Skills of the postings that the fact table has, by their keys alone: the fact's other columns cost
    joins. Names become keys first, so that the large join sorts narrow rows. registry: as fact returns it."""
    named = postings.select("source", "job_key", _posting().alias("posting"))
    keyed = named.join(registry, "posting").select("source", "job_key", "job_posting_key")
    rows = job_skills.join(skills.select(F.col("skill_name").alias("skill"), "skill_key"), "skill").select("source", "job_key", "skill_key")
    return dealt(rows, "source", "job_key").join(keyed, ["source", "job_key"]).select("job_posting_key", "skill_key").distinct()


def empty_registries(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "company_keys": spark.createDataFrame([], "company_norm string, company_key long"),
        "skill_keys": spark.createDataFrame([], "skill_name string, skill_key int"),
        "posting_keys": spark.createDataFrame([], "posting string, job_posting_key long"),
    }


def build(postings: DataFrame, job_skills: DataFrame, registries: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All tables of the warehouse, the key registries among them. Rebuilding with the registries
    of the last build keeps every key; postings that are gone from the clean layer are gone here."""
    spark = postings.sparkSession
    companies, company_keys = dim_company(postings, registries["company_keys"])
    skills, skill_keys = dim_skill(job_skills, registries["skill_keys"])
    facts, posting_keys = fact(postings, job_skills, companies, registries["posting_keys"])
    return {
        "dim_date": dim_date(spark), "dim_location": dim_location(spark), "dim_company": companies, "dim_skill": skills,
        "fact": facts, "bridge": bridge(job_skills, postings, posting_keys, skills),
        "company_keys": company_keys, "skill_keys": skill_keys, "posting_keys": posting_keys,
    }
