"""From the latest raw versions to clean postings and their skills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import geo, salary, skills, text
from tidemark.operators import versions
from tidemark.schemas import POSTING
from tidemark.shared import kept
from tidemark.sources import adapters


def clean(latest: DataFrame) -> DataFrame:
    """One row per posting with the clean columns and ``skills``. latest: id, source, job_key,
    payload, first_seen, last_seen."""
    rows = adapters.adapt(latest.select("id", "source", "job_key", "payload", "first_seen", "last_seen"))
    rows = rows.withColumn("title_raw", F.trim(F.coalesce("title", F.lit(""))))
    # a step that names the one before it many times has that one as a column, so that it is worked out once
    rows = rows.withColumn("title_tidy", text.tidy_title(F.col("title_raw"))).withColumn("title_bare", text.placeless_title(F.col("title_tidy")))
    rows = rows.withColumn("title_clean", text.fix_case(F.col("title_bare")))
    rows = rows.withColumn("description_text", text.redact_contacts(text.html_to_text(F.col("description_html"))))
    rows = rows.withColumn("location_marked", geo.marked_location(F.col("location_text"))).withColumn("company", text.clean_company(F.col("company")))
    at = F.col("location_text"), F.col("location_marked")
    rows = rows.withColumn("place_name", geo.place_in(*at)).withColumn("place", geo.county_of(F.col("place_name"))).withColumn("says_remote", geo.says_remote(*at))
    rows = rows.withColumn("title_norm", text.norm_text(F.col("title_clean"))).withColumn("company_bare", text.without_legal_forms(F.col("company")))
    rows = rows.withColumn("company_words", text.norm_text(F.col("company_bare"))).withColumn("company_norm", text.named_employer(F.col("company_words")))
    structured = salary.from_structured(F.col("base_currency"), F.col("base_low"), F.col("base_high"), F.col("base_single"), F.col("base_unit"))
    rows = rows.withColumn("paid", F.coalesce(structured, salary.from_text(F.col("salary_text")), salary.from_text(F.col("description_text"))))
    both = (F.col("title_norm") != "") & F.col("company_norm").isNotNull()
    dedup = F.sha1(F.concat_ws("|", "title_norm", "company_norm", F.coalesce(F.col("place.county_code").cast("string"), F.lit(""))))
    none = lambda c: F.nullif(F.col(c), F.lit(""))
    said = F.concat(F.col("title_clean"), F.lit(". "), F.col("skills_text"), F.lit(". "), F.col("description_text"))
    columns = {
        "raw_id": F.col("id"),
        "url": F.coalesce("url", F.when(F.col("job_key").startswith("http"), F.col("job_key"))),
        "title_raw": none("title_raw"),
        "title_clean": none("title_clean"),
        "title_norm": none("title_norm"),
        "seniority": text.seniority(F.col("title_clean")),
        "location_raw": none("location_text"),
        "county": F.col("place.county"),
        "county_code": F.col("place.county_code"),
        "is_remote": F.col("says_remote") | F.coalesce("remote_hint", F.lit(False)),
        "date_posted": text.parse_date(F.col("date_posted")),
        "valid_through": text.parse_date(F.col("valid_through")),
        "salary_currency": F.col("paid.currency"),
        "salary_min": F.col("paid.min"),
        "salary_max": F.col("paid.max"),
        "salary_period": F.col("paid.period"),
        "salary_min_monthly_kes": F.col("paid.min_monthly_kes"),
        "salary_max_monthly_kes": F.col("paid.max_monthly_kes"),
        "salary_source": F.col("paid.source"),
        "description_text": none("description_text"),
        "dedup_key": F.when(both, dedup),
        "first_seen_at": F.col("first_seen"),
        "last_seen_at": F.col("last_seen"),
    }
    chosen = [columns.get(field.name, F.col(field.name)).try_cast(field.dataType).alias(field.name) for field in StructType.fromDDL(POSTING).fields]
    return rows.select(*chosen, skills.extract_skills(said).alias("skills"))


def posting_skills(cleaned: DataFrame) -> DataFrame:
    """(source, job_key, skill, category) rows."""
    return cleaned.select("source", "job_key", F.inline("skills"))


def build(raw: DataFrame, sightings: DataFrame, sources: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean postings with duplicates flagged, and their skills, straight from the raw layer. The
    cleaned rows, which three plans read, are written once."""
    cleaned = kept(clean(versions.first_last_seen(raw, sightings, sources)), "cleaned")
    return versions.flag_duplicates(cleaned.drop("skills")), posting_skills(cleaned)


def profile(cleaned: DataFrame) -> DataFrame:
    """One row: how many postings, and how many have each field."""
    filled = ["company", "date_posted", "county", "salary_currency", "dedup_key"]
    return cleaned.agg(F.count(F.lit(1)).alias("postings"), *[F.count(c).alias(c) for c in filled], F.count_if("is_remote").alias("remote"), F.count_if(F.size("skills") > 0).alias("with_skills"))


def unmapped_locations(cleaned: DataFrame, most: int = 10) -> DataFrame:
    """The most frequent places that no county was found for."""
    counted = cleaned.filter("county IS NULL AND location_raw IS NOT NULL").groupBy("location_raw").agg(F.count(F.lit(1)).alias("postings"))
    return counted.orderBy(F.desc("postings"), "location_raw").limit(most)
