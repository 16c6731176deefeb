"""The star schema read out of the TPC-H-like tables, so that views run over data of any size.

Orders are postings, their priority is the source, customers are companies, nations are places,
distinct part types are skills, and three days of each posting are its sightings. LENS_SQL builds
the same tables in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.plans import warehouse

TITLES = ["Data Analyst", "Software Developer", "Accountant", "Nurse", "Chef", "Widget Polisher", "Senior Data Engineer"]
CATEGORIES = ["Data & Analytics", "Software & IT", "Finance & Accounting", "Health & Medical", "Hospitality & Tourism", "Other", "Data & Analytics"]
HIDDEN_SOURCE = "5-LOW"
SHIFT_DAYS = 3652  # orders begin before the date dimension does


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS).alias("posted"), "o_orderpriority")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    items = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.date_add(F.to_date("l_shipdate"), SHIFT_DAYS).alias("shipped"))
    named = items.join(read(spark, sf_dir, "part").select("p_partkey", "p_type"), items["l_partkey"] == F.col("p_partkey")).select("l_orderkey", F.col("p_type").alias("skill_name")).distinct()
    until = items.groupBy("l_orderkey").agg(F.max("shipped").alias("until"))
    n = F.col("o_orderkey")
    rows = orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).join(until, n == F.col("l_orderkey"), "left")
    first = F.date_add("posted", (n % 5).cast("int") - 1)
    last = F.date_add(first, (n % 23).cast("int"))
    price = F.col("o_totalprice").cast("decimal(14,2)")
    fact = rows.select(
        n.alias("job_posting_key"), F.col("o_orderpriority").alias("source"), n.cast("string").alias("job_key"), F.col("c_custkey").alias("company_key"), F.col("c_nationkey").alias("location_key"),
        dates.date_key(F.col("posted")).alias("posted_date_key"), dates.date_key(F.col("until")).alias("valid_through_date_key"), dates.date_key(first).alias("first_seen_date_key"), dates.date_key(last).alias("last_seen_date_key"),
        F.get(F.array(*map(F.lit, TITLES)), (n % 7).cast("int")).alias("title_clean"), F.col("c_mktsegment").alias("seniority"), F.lit(None).cast("string").alias("employment_type"), F.lit(None).cast("string").alias("industry"),
        F.concat(F.lit("https://jobs.example/"), n).alias("url"), (n % 11 == 0).alias("is_remote"), (F.col("o_orderstatus") == "P").alias("is_duplicate"), (n % 3 == 0).alias("has_salary"),
        F.when(n % 3 == 0, price).alias("salary_min_monthly_kes"), F.when(n % 3 == 0, price + 1000).cast("decimal(14,2)").alias("salary_max_monthly_kes"), F.when(n % 3 == 0, price + 500).cast("decimal(14,2)").alias("salary_mid_monthly_kes"),
        F.lit("structured").alias("salary_source"), F.lit(0).alias("skill_count"), F.when(F.col("until") >= F.col("posted"), F.datediff("until", "posted")).alias("days_advertised"),
    )
    nations = read(spark, sf_dir, "nation")
    skills = named.select("skill_name").distinct().select(F.abs(F.hash("skill_name")).alias("skill_key"), "skill_name", F.substring("skill_name", 1, 1).alias("category"))
    seen = fact.select("source", "job_key", F.explode(F.array(first_of("first_seen_date_key"), first_of("last_seen_date_key"))).alias("seen_on")).distinct()
    return {
        "fact": fact,
        "dim_company": customers.select(F.col("c_custkey").alias("company_key"), F.col("c_name").alias("company_norm"), F.col("c_name").alias("company_name")),
        "dim_location": nations.select(F.col("n_nationkey").alias("location_key"), F.when(F.col("n_regionkey") == 4, "remote").otherwise("county").alias("location_type"), F.lit(None).cast("int").alias("county_code"), F.col("n_name").alias("county_name")),
        "dim_date": warehouse.dim_date(spark),
        "dim_skill": skills,
        "bridge": named.join(skills, "skill_name").select(F.col("l_orderkey").alias("job_posting_key"), "skill_key"),
        "publishing": orders.select(F.col("o_orderpriority").alias("source")).distinct().withColumn("publishable", F.col("source") != HIDDEN_SOURCE),
        "sightings": seen.withColumn("fetched", F.lit(True)),
    }


def first_of(key: str):
    return F.try_to_date(F.col(key).cast("string"), "yyyyMMdd")


_CASE = lambda values: "CASE o_orderkey % 7 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"

LENS_SQL = f"""WITH skills_of AS (SELECT DISTINCT l_orderkey, p_type AS skill_name FROM lineitem JOIN part ON l_partkey = p_partkey),
untils AS (SELECT l_orderkey, max(CAST(l_shipdate AS DATE) + {SHIFT_DAYS}) AS until FROM lineitem GROUP BY l_orderkey),
fact AS (
  SELECT o_orderkey AS job_posting_key, o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS job_key, c_name AS company_name, n_name AS county_name,
    CASE WHEN n_regionkey = 4 THEN 'remote' ELSE 'county' END AS location_type, (CAST(o_orderdate AS DATE) + {SHIFT_DAYS}) AS date_posted, until,
    (CAST(o_orderdate AS DATE) + {SHIFT_DAYS}) + CAST(o_orderkey % 5 - 1 AS INTEGER) AS first_seen, (CAST(o_orderdate AS DATE) + {SHIFT_DAYS}) + CAST(o_orderkey % 5 - 1 + o_orderkey % 23 AS INTEGER) AS last_seen,
    {_CASE(TITLES)} AS title, {_CASE(CATEGORIES)} AS category, c_mktsegment AS seniority, o_orderkey % 11 = 0 AS is_remote, o_orderstatus = 'P' AS is_duplicate, o_orderkey % 3 = 0 AS has_salary,
    CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DECIMAL(14,2)) + 500 END AS salary_mid, CASE WHEN until >= (CAST(o_orderdate AS DATE) + {SHIFT_DAYS}) THEN until - (CAST(o_orderdate AS DATE) + {SHIFT_DAYS}) END AS days_advertised
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN untils ON l_orderkey = o_orderkey
), live AS (SELECT * FROM fact WHERE NOT is_duplicate), base AS (SELECT *, CAST(round(salary_mid) AS INTEGER) AS salary_mid_kes FROM live WHERE source <> '{HIDDEN_SOURCE}'),
sightings AS (SELECT DISTINCT source, job_key, unnest([first_seen, last_seen]) AS seen_on FROM fact)
"""
