"""What readers ask of the published views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.quality import within
from tidemark.plans.result_cache import ResultCache

MOST_RESULTS = 500


def like_text(text: str) -> str:
    """A pattern that finds the text anywhere, its wildcards taken literally."""
    return "%" + text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"


def matching(
    text: str | None = None, counties: list[str] | None = None, categories: list[str] | None = None, seniorities: list[str] | None = None, sources: list[str] | None = None,
    skills: list[str] | None = None, all_skills: bool = False, with_salary: bool = False, remote: bool = False, posted_since: date | None = None,
) -> Column:
    """All given conditions; none given keeps everything."""
    conditions = [F.lit(True)]
    if text:
        conditions.append(F.col("title").ilike(like_text(text)) | F.coalesce(F.col("company_name").ilike(like_text(text)), F.lit(False)))
    for name, values in (("county_name", counties), ("category", categories), ("seniority", seniorities), ("source", sources)):
        if values:
            conditions.append(F.col(name).isin(values))
    if skills:
        wanted = F.array(*[F.lit(s) for s in skills])
        conditions.append(F.size(F.array_except(wanted, "skills")) == 0 if all_skills else F.arrays_overlap("skills", wanted))
    if with_salary:
        conditions.append(F.col("has_salary"))
    if remote:
        conditions.append(F.col("is_remote"))
    if posted_since:
        conditions.append(F.col("date_posted") >= F.lit(posted_since))
    found = conditions[0]
    for condition in conditions[1:]:
        found = found & condition
    return found


def search(jobs: DataFrame, most: int = MOST_RESULTS, **filters) -> tuple[DataFrame, DataFrame]:
    """The newest matching postings, and a one-row total. The total is an aggregation of its own,
    as a window over everything would gather all matches in one task."""
    rows = jobs.filter(matching(**filters))
    return rows.orderBy(F.col("date_posted").desc_nulls_last(), F.col("job_posting_key")).limit(most), rows.agg(F.count(F.lit(1)).alias("total"))


def filter_options(jobs: DataFrame, column: str) -> DataFrame:
    """Values to filter by, the most frequent first; for skills those of the array."""
    value = F.explode(column) if jobs.schema[column].dataType.typeName() == "array" else F.col(column)
    return jobs.select(value.alias("value")).filter("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("postings")).orderBy(F.desc("postings"), "value")


def kpis(jobs: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return jobs.agg(
        n.alias("postings"), F.countDistinct("company_name").alias("companies"), F.countDistinct(F.when(F.col("location_type") == "county", F.col("county_name"))).alias("counties"),
        F.round((100 * F.count_if("has_salary")).cast("decimal(38,6)") / F.nullif(n, F.lit(0)), 1).cast("double").alias("pct_with_salary"), F.max("date_posted").alias("newest"),
    )


def top(jobs: DataFrame, column: str, most: int = 15) -> DataFrame:
    return filter_options(jobs, column).limit(most)


def daily_series(jobs: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Postings by day over the last days."""
    recent = F.col("date_posted") >= F.date_sub(F.lit(as_of), days)
    return jobs.filter(recent).groupBy("date_posted").agg(F.count(F.lit(1)).alias("postings")).orderBy("date_posted")


def cv_match(jobs: DataFrame, skills: list[str], most: int = 25) -> DataFrame:
    """Postings by how many of one's skills they name, with those that match and those that lack."""
    own = F.array(*[F.lit(s) for s in skills]).cast("array<string>")
    rows = jobs.withColumn("matched", F.array_sort(F.array_intersect("skills", own))).withColumn("missing", F.array_sort(F.array_except("skills", own)))
    rows = rows.withColumn("overlap", F.size("matched")).filter("overlap > 0")
    return rows.orderBy(F.desc("overlap"), F.col("date_posted").desc_nulls_last(), "job_posting_key").limit(most)


def skill_chart(demand: DataFrame, balanced: bool = False, most: int = 15) -> DataFrame:
    return demand.orderBy(F.desc("balanced_pct" if balanced else "pooled_pct"), F.desc("postings"), "skill_name").limit(most)


def dominant_source(coverage: DataFrame, least_share: float = 60.0) -> DataFrame:
    """Sources that make up so much of the data that totals speak for them alone."""
    return coverage.filter(F.col("share_pct") >= least_share).select("source", "share_pct")


def enough_weeks(weekly: DataFrame, least: int = 3) -> bool:
    return weekly.filter("week_complete").select("week_start").distinct().count() >= least


#: Views that readers may see, a column that none of them may have, seconds of a query.
PUBLIC_VIEWS = [
    "v_public_jobs",
    "v_public_dq_summary",
    "v_public_runs",
    "v_public_source_freshness",
    "v_coverage_sources",
    "v_coverage_overall",
    "v_skill_demand",
    "v_county_summary",
    "v_weekly_new_postings",
    "v_advertised_window_stats",
    "v_feed_depth",
    "v_lifetime_km",
    "v_lifetime_summary",
]
READER_SECONDS = 15.0
FORBIDDEN_COLUMNS = {"description_text", "description_html", "payload"}


class PublicCatalog:
    """Read access to the allowed views and nothing else."""

    def __init__(self, views: dict[str, DataFrame], cache: ResultCache | None = None):
        for name, view in views.items():
            if name in PUBLIC_VIEWS and FORBIDDEN_COLUMNS & set(view.columns):
                raise PermissionError(f"{name} holds columns that must not be shown")
        self._views = {k: v for k, v in views.items() if k in PUBLIC_VIEWS}
        self.cache = ResultCache() if cache is None else cache

    def names(self) -> list[str]:
        return sorted(self._views)

    def read(self, name: str) -> DataFrame:
        if name not in self._views:
            raise PermissionError(f"{name} is not a public view")
        return self._views[name]

    def fetch(self, name: str, query=lambda view: view, seconds: float = READER_SECONDS):
        """The rows of a query over one view, as an Arrow table: kept for a while, of bounded size, and
        stopped if it takes too long."""
        wanted = query(self.read(name))
        return within(wanted.sparkSession, seconds, lambda: self.cache.fetch(wanted))


def write_csv(rows: DataFrame, path: str, most: int | None = None) -> None:
    """Rows as CSV files with a header; with ``most`` the first so many, in one file."""
    rows = rows if most is None else rows.limit(most).coalesce(1)
    flat = [F.array_join(F.col(c).cast("array<string>"), "; ").alias(c) if kind.startswith("array<") else F.col(c) for c, kind in rows.dtypes]
    rows.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
