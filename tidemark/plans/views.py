"""Analytical views over the star schema. Each takes its tables by name and returns a DataFrame.

Dimensions are small beside the fact and join by broadcast where Catalyst sees that they are.
Ratios are rounded as decimals so that halves round away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import classify, dates, stats
from tidemark.operators.selection import percentiles
from tidemark.shared import kept

Tables = dict[str, DataFrame]
TECH = ["Data & Analytics", "Software & IT"]


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, null without a whole."""
    return F.round((F.lit(100) * part).cast("decimal(38,6)") / F.nullif(whole, F.lit(0)), digits).cast("double")


def rounded(x: Column, digits: int) -> Column:
    return F.round(x.cast("decimal(38,9)"), digits).cast("double")


def _named(found: DataFrame, group: str) -> DataFrame:
    """``found`` with its group under another name, to be joined null-safe."""
    return found.withColumnRenamed(group, f"of_{group}")


def live(t: Tables) -> DataFrame:
    return t["fact"].filter(~F.col("is_duplicate"))


def _day(t: Tables, key: str, name: str) -> DataFrame:
    """The date dimension in one of its roles."""
    return t["dim_date"].select(F.col("date_key").alias(key), F.col("full_date").alias(name))


def jobs(t: Tables) -> DataFrame:
    """Flat postings without duplicates."""
    d = t["dim_date"].select(F.col("date_key").alias("posted_date_key"), F.col("full_date").alias("date_posted"), "cal_year", "cal_month", "iso_week")
    rows = live(t).join(t["dim_company"], "company_key").join(t["dim_location"].drop("county_code"), "location_key").join(d, "posted_date_key")
    return rows.select(
        "job_posting_key", "source", "url", "title_clean", "seniority", "employment_type", "industry", "company_name", "county_name", "location_type", "is_remote",
        "date_posted", "cal_year", "cal_month", "iso_week", "has_salary", "salary_min_monthly_kes", "salary_max_monthly_kes", "salary_mid_monthly_kes", "skill_count", "days_advertised",
    )


def top_skills(t: Tables) -> DataFrame:
    total = live(t).agg(F.count(F.lit(1)).alias("n"))
    rows = t["bridge"].join(live(t).select("job_posting_key"), "job_posting_key").join(t["dim_skill"], "skill_key")
    counted = rows.groupBy("skill_name", "category").agg(F.count(F.lit(1)).alias("postings"))
    return counted.join(F.broadcast(total)).select("skill_name", "category", "postings", pct(F.col("postings"), F.col("n")).alias("pct_of_postings")).orderBy(F.desc("postings"), "skill_name")


def hiring_by_county(t: Tables) -> DataFrame:
    return jobs(t).groupBy("county_name", "location_type", "cal_year", "cal_month").agg(F.count(F.lit(1)).alias("postings"))


def salary_by_seniority(t: Tables) -> DataFrame:
    mid = F.col("salary_mid_monthly_kes")
    paid = kept(live(t).filter("has_salary").select("seniority", mid), "paid")
    counted = paid.groupBy("seniority").agg(F.count(F.lit(1)).alias("postings_with_salary"), rounded(F.avg(mid), 0).alias("avg_band_midpoint_kes"))
    median = _named(percentiles(paid, ["seniority"], mid, {"median": 0.5}, stored=True), "seniority")
    rows = counted.join(median, F.col("seniority").eqNullSafe(F.col("of_seniority")), "left")
    return rows.select("seniority", "postings_with_salary", "avg_band_midpoint_kes", rounded(F.col("median"), 0).alias("median_band_midpoint_kes")).orderBy(F.desc("postings_with_salary"), "seniority")


def advertised_window(t: Tables) -> DataFrame:
    return live(t).groupBy("source").agg(
        F.count(F.lit(1)).alias("postings"), F.count("days_advertised").alias("postings_with_window"), rounded(F.sum("days_advertised").cast("decimal(38,6)") / F.count("days_advertised"), 1).alias("avg_days_advertised")
    )


def posting_lifetimes(t: Tables) -> DataFrame:
    """First and last sighting of each posting, and whether it was seen within three days of its
    source's last one. A lower bound of its real lifetime."""
    rows = t["fact"].join(_day(t, "first_seen_date_key", "first_seen"), "first_seen_date_key").join(_day(t, "last_seen_date_key", "last_seen"), "last_seen_date_key")
    newest = t["fact"].join(_day(t, "last_seen_date_key", "last_seen"), "last_seen_date_key").groupBy("source").agg(F.max("last_seen").alias("newest"))
    return rows.filter("NOT is_duplicate").join(newest, "source").select(
        "source", "job_key", "title_clean", "first_seen", "last_seen", F.datediff("last_seen", "first_seen").alias("days_observed"), (F.col("last_seen") >= F.date_sub("newest", 3)).alias("seen_recently")
    )


def skills_by_posting(t: Tables) -> DataFrame:
    """Sorted skills of each posting; aggregated once rather than per posting."""
    return t["bridge"].join(t["dim_skill"], "skill_key").groupBy("job_posting_key").agg(F.array_sort(F.collect_list("skill_name")).alias("skills"))


def jobs_enriched(t: Tables) -> DataFrame:
    """Postings with category, skills and whether they may be shown; unlisted sources may not."""
    d = t["dim_date"].select(F.col("date_key").alias("posted_date_key"), F.col("full_date").alias("date_posted"))
    rows = live(t).join(t["dim_company"], "company_key").join(t["dim_location"].drop("county_code"), "location_key").join(d, "posted_date_key")
    rows = rows.join(t["publishing"], "source", "left").join(skills_by_posting(t), "job_posting_key", "left")
    kes = lambda c: F.round(F.col(f"salary_{c}_monthly_kes")).cast("int").alias(f"salary_{c}_kes")
    return rows.select(
        "job_posting_key", "source", "url", F.col("title_clean").alias("title"), "company_name", "county_name", "location_type", "is_remote", "date_posted", "seniority",
        classify.classify_category(F.col("title_clean"), F.col("industry")).alias("category"), "industry", "employment_type", "has_salary", kes("min"), kes("max"), kes("mid"), "salary_source",
        F.coalesce("skills", F.array().cast("array<string>")).alias("skills"), F.coalesce("publishable", F.lit(False)).alias("publishable"),
    )


def public_jobs(t: Tables) -> DataFrame:
    return jobs_enriched(t).filter("publishable")


def analytics_base(t: Tables) -> DataFrame:
    """Public postings with their sightings; what the statistics below are made from. Worth
    persisting when several of them are wanted."""
    seen = t["fact"].select("job_posting_key", "days_advertised", "first_seen_date_key", "last_seen_date_key")
    seen = seen.join(_day(t, "first_seen_date_key", "first_seen"), "first_seen_date_key").join(_day(t, "last_seen_date_key", "last_seen"), "last_seen_date_key")
    columns = "job_posting_key source title company_name county_name location_type is_remote date_posted seniority category has_salary salary_mid_kes skills".split()
    return public_jobs(t).select(*columns).join(seen.select("job_posting_key", "days_advertised", "first_seen", "last_seen"), "job_posting_key")


def latest_dq(results: DataFrame) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("check_name").orderBy(F.col("run_at").desc_nulls_last()))
    return results.withColumn("nth", nth).filter("nth = 1").select("check_name", "layer", "severity", "passed", "violations", "total", "detail", "run_at")


def public_dq_summary(results: DataFrame) -> DataFrame:
    failing = lambda s: F.count_if(~F.col("passed") & (F.col("severity") == s))
    return latest_dq(results).groupBy("layer").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed"), failing("error").alias("failing_errors"), failing("warn").alias("failing_warnings"), F.max("run_at").alias("last_checked")
    )


def public_runs(runs: DataFrame, most: int = 30) -> DataFrame:
    return runs.orderBy(F.desc("id")).limit(most).select("id", "started_at", "finished_at", dates.seconds_between(F.col("started_at"), F.col("finished_at")).cast("int").alias("duration_s"), "status")


def source_freshness(t: Tables) -> DataFrame:
    shown = t["publishing"].filter("publishable").select("source")
    return t["sightings"].join(shown, "source").groupBy("source").agg(F.max("seen_on").alias("last_seen_on"), F.countDistinct("job_key").alias("postings_seen_total"))


def coverage_sources(base: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    counted = base.groupBy("source").agg(
        n.alias("postings"), F.min("first_seen").alias("first_crawl"), F.max("last_seen").alias("last_crawl"), F.min("date_posted").alias("oldest_posted"), F.max("date_posted").alias("newest_posted"),
        pct(F.count_if("has_salary"), n).alias("pct_with_salary"), pct(F.count_if(F.col("location_type") == "county"), n).alias("pct_with_county"), F.count_if(F.col("category").isin(TECH)).alias("tech_postings"),
    )
    every = F.sum("postings").over(Window.partitionBy(F.lit(0)))  # a row for each source
    return counted.select("source", "postings", pct(F.col("postings"), every).alias("share_pct"), "first_crawl", "last_crawl", (F.datediff("last_crawl", "first_crawl") + 1).alias("history_days"), "oldest_posted", "newest_posted", "pct_with_salary", "pct_with_county", "tech_postings")


def coverage_overall(base: DataFrame) -> DataFrame:
    return base.agg(
        F.count(F.lit(1)).alias("postings"), F.countDistinct("source").alias("sources"), (F.datediff(F.max("last_seen"), F.min("first_seen")) + 1).alias("history_days"), F.min("first_seen").alias("first_crawl"),
        F.max("last_seen").alias("last_crawl"), F.count_if(F.col("category").isin(TECH)).alias("tech_postings"), F.count_if(F.col("location_type") == "county").alias("county_located"),
    )


def skill_demand(base: DataFrame, dim_skill: DataFrame, least_tech: int = 10, reliable: int = 5) -> DataFrame:
    """Share of tech postings that name a skill: pooled with its interval, and averaged over sources.

    Sources with too few tech postings are left out of the grid, yet a skill that only they name
    stands in it with zeros. The grid has a row for each skill and source, both few.
    """
    tech = base.filter(F.col("category").isin(TECH))
    totals = tech.groupBy("source").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_tech)
    mentions = tech.select("source", F.explode("skills").alias("skill")).groupBy("source", "skill").agg(F.count(F.lit(1)).alias("m"))
    names = mentions.select("skill").distinct()
    listed = totals.agg(F.collect_list(F.struct("source", "n")).alias("of"))  # a row that holds the sources
    grid = names.join(F.broadcast(listed)).select("skill", F.inline("of")).join(mentions, ["skill", "source"], "left").withColumn("m", F.coalesce("m", F.lit(0)))
    k, n = F.sum("m"), F.sum("n")
    found = grid.groupBy("skill").agg(
        k.alias("postings"), n.alias("n_tech"), pct(k, n).alias("pooled_pct"), rounded(100 * stats.wilson_low(k, n), 1).alias("ci_low_pct"), rounded(100 * stats.wilson_high(k, n), 1).alias("ci_high_pct"),
        rounded(F.avg(F.lit(100.0) * F.col("m") / F.col("n")), 1).alias("balanced_pct"), F.count_if(F.col("m") > 0).alias("sources_mentioning"), F.count(F.lit(1)).alias("sources_total"), (k >= reliable).alias("reliable"),
    )
    named = dim_skill.select(F.col("skill_name").alias("skill"), F.col("category").alias("skill_category"))
    return found.join(named, "skill", "left").withColumnRenamed("skill", "skill_name")


def county_summary(base: DataFrame, least_salary: int = 5, reliable: int = 10) -> DataFrame:
    located = kept(base.filter(F.col("location_type") == "county").select("county_name", "source", "has_salary", "salary_mid_kes"), "located")
    n, paid = F.count(F.lit(1)), F.count_if("has_salary")
    counted = located.groupBy("county_name").agg(
        n.alias("postings"), F.countDistinct("source").alias("sources"), paid.alias("n_salary"),
    )
    median = _named(percentiles(located.filter("has_salary"), ["county_name"], F.col("salary_mid_kes"), {"median": 0.5}, stored=True), "county_name")
    counted = counted.join(median, F.col("county_name").eqNullSafe(F.col("of_county_name")), "left").drop("of_county_name")
    counted = counted.withColumn("median_salary_band_mid_kes", F.when(F.col("n_salary") >= least_salary, rounded(F.col("median"), 0)))
    every = F.sum("postings").over(Window.partitionBy(F.lit(0)))  # a row for each county
    rows = counted.withColumn("n_located", every)
    k, total = F.col("postings"), F.col("n_located")
    return rows.select(
        "county_name", "postings", "n_located", pct(k, total).alias("share_pct"), rounded(100 * stats.wilson_low(k, total), 1).alias("ci_low_pct"), rounded(100 * stats.wilson_high(k, total), 1).alias("ci_high_pct"),
        "sources", "n_salary", "median_salary_band_mid_kes", (k >= reliable).alias("reliable"),
    )


def weekly_new(base: DataFrame) -> DataFrame:
    """New postings by week, of those posted after their source was first read."""
    crawl = base.groupBy("source").agg(F.min("first_seen").alias("crawl_start"), F.max("last_seen").alias("crawl_end"))
    week = F.col("week_start")
    rows = base.join(crawl, "source").filter("date_posted >= crawl_start").withColumn("week_start", dates.week_start(F.col("date_posted")))
    whole = (week >= F.col("crawl_start")) & (F.date_add(week, 6) <= F.col("crawl_end"))
    return rows.groupBy("week_start", "source", "county_name", "location_type", whole.alias("week_complete")).agg(F.count(F.lit(1)).alias("postings"))


def advertised_window_stats(base: DataFrame) -> DataFrame:
    """Quartiles of the advertised window by source, and over all; the last row is there without data too."""
    rows, days = kept(base.select("source", "days_advertised"), "advertised"), F.col("days_advertised")
    n, known = F.count(F.lit(1)), F.count("days_advertised")
    columns = [n.alias("postings"), known.alias("with_window"), pct(known, n).alias("pct_with_window")]
    quartiles = {"p25_days": 0.25, "median_days": 0.5, "p75_days": 0.75}
    shown = [F.col(c) for c in ("source", "postings", "with_window", "pct_with_window")] + [rounded(F.col(c), 1).alias(c) for c in quartiles]
    by_source = rows.groupBy("source").agg(*columns).join(_named(percentiles(rows, ["source"], days, quartiles, stored=True), "source"), F.col("source").eqNullSafe(F.col("of_source")), "left")
    over_all = rows.agg(F.lit("all").alias("source"), *columns).join(percentiles(rows, [], days, quartiles, stored=True), F.lit(True), "left")  # a row each
    return by_source.select(*shown).unionByName(over_all.select(*shown))


def feed_depth(t: Tables) -> DataFrame:
    """How many days of postings one day of reading a source covers."""
    shown = t["publishing"].filter("publishable").select("source")
    posted = t["fact"].select("source", "job_key", "posted_date_key").join(_day(t, "posted_date_key", "posted"), "posted_date_key")
    return t["sightings"].join(shown, "source").join(posted, ["source", "job_key"]).groupBy("source", "seen_on").agg(
        F.count(F.lit(1)).alias("postings_seen"), F.min("posted").alias("oldest_posted"), F.max("posted").alias("newest_posted"), F.datediff(F.max("posted"), F.min("posted")).alias("window_days")
    )


def lifetime_observations(base: DataFrame, sightings: DataFrame, absent_days: int = 3) -> DataFrame:
    """Observed durations of postings posted since their source is read, and whether they left the
    listing: ``absent_days`` reading days have passed since the last sighting.

    That is the case exactly if the last but (absent_days - 1) reading day of the source is later,
    so one day per source replaces counting days for each posting.
    """
    days = sightings.select("source", "seen_on").distinct()
    nth = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("seen_on")))
    edge = days.withColumn("nth", nth).filter(F.col("nth") == absent_days).select("source", F.col("seen_on").alias("edge"))
    started = base.groupBy("source").agg(F.min("first_seen").alias("started"))
    rows = base.join(started, "source").filter("date_posted >= started").join(edge, "source", "left")
    return rows.select("source", "job_posting_key", F.greatest(F.datediff("last_seen", "date_posted") + 1, F.lit(1)).alias("duration_days"), F.coalesce(F.col("edge") > F.col("last_seen"), F.lit(False)).alias("left_listing"))


def lifetime_km(observations: DataFrame) -> DataFrame:
    curve = stats.km_survival(observations, ["source"], "duration_days", "left_listing")
    return curve.select("source", F.col("t").alias("age_days"), "at_risk", "n_events", F.round("survival", 4).alias("survival"))


def lifetime_summary(observations: DataFrame, depth: DataFrame, least_events: int = 30) -> DataFrame:
    """Median lifetime by source, and whether to trust it: enough events, and well beyond what one
    reading of the source shows."""
    counted = observations.groupBy("source").agg(F.count(F.lit(1)).alias("cohort_postings"), F.count_if("left_listing").alias("left_listing"))
    median = lifetime_km(observations).filter("survival <= 0.5").groupBy("source").agg(F.min("age_days").alias("median_days"))
    window = percentiles(depth, ["source"], F.col("window_days"), {"w": 0.5})
    rows = counted.join(median, "source", "left").join(window, "source", "left")
    # three-valued: too few events or no median settle it, an unknown window leaves it open
    trusted = (F.col("left_listing") >= least_events) & F.col("median_days").isNotNull() & (F.col("median_days") > 1.5 * F.col("w"))
    return rows.select("source", "cohort_postings", "left_listing", (F.col("cohort_postings") - F.col("left_listing")).alias("still_visible"), "median_days", rounded(F.col("w"), 1).alias("feed_window_days"), trusted.alias("trustworthy"))


def trend_pivot(weekly: DataFrame, most: int = 5) -> DataFrame:
    """Complete weeks by the counties with the most postings, and their total; gaps are 0."""
    whole = weekly.filter("week_complete")
    counties = whole.filter(F.col("location_type") == "county").groupBy("county_name").agg(F.sum("postings").alias("n")).orderBy(F.desc("n"), "county_name").limit(most)
    named = [r["county_name"] for r in counties.collect()]  # at most `most` rows
    total = whole.groupBy("week_start").agg(F.sum("postings").alias("total"))
    if not named:
        return total
    by_county = whole.filter(F.col("location_type") == "county").groupBy("week_start").pivot("county_name", named).agg(F.sum("postings"))
    return total.join(by_county, "week_start", "left").na.fill(0)
