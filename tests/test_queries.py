"""Registered queries against their SQL, on the smallest tables."""

import os

import duckdb
import pytest
from conftest import SF

from tidemark import catalog, cleaning_catalog, raw_catalog  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: A share of the queries; the driver compares all of them.
CHOSEN = ["latest_version", "dedup_flags", "top_skills", "skill_demand_grid", "county_summary", "lifetime_summary", "search", "skill_extract", "dim_date", "dq_unique", "running_counts", "skill_dictionary", "salary_text", "clean_title", "map_location", "warehouse_fact", "linked_data", "classify_rules", "adapter_myjobmag", "adapter_jsearch", "clean_postings"]


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        c.sql(f"create view {t} as select * from read_parquet('{path}/*.parquet')" if os.path.isdir(path) else f"create view {t} as select * from read_parquet('{path}')")
    return c


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)[:19].replace(" 00:00:00", "")


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    answer = duck.execute(catalog.ORACLES[name])
    at = [[d[0] for d in answer.description].index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in answer.fetchall())


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES) and len(catalog.QUERIES) > 60
