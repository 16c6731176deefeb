"""Results that are kept, bounded and exported; functions in SQL texts."""

import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import sqlfunctions
from tidemark.functions import classify, stats
from tidemark.plans import serving
from tidemark.plans.result_cache import ResultCache, ResultTooLarge


def test_results_are_kept_by_what_they_mean(spark):
    now = [0.0]
    cache = ResultCache(seconds=300, most_rows=100, clock=lambda: now[0])
    rows = spark.range(50).withColumn("x", F.col("id") * 2)
    ask = lambda least: rows.filter(F.col("x") > least).select("id")
    assert cache.fetch(ask(10)).num_rows == 44 and cache.fetched == 1
    assert cache.fetch(ask(10)).num_rows == 44 and cache.fetched == 1  # written anew, the same plan
    assert cache.fetch(ask(20)).num_rows == 39 and cache.fetched == 2
    assert cache.fetch(ask(10).withColumnRenamed("id", "other")).column_names == ["other"] and cache.fetched == 3
    now[0] = 301.0
    cache.fetch(ask(10))
    assert cache.fetched == 4 and len(cache) == 1
    with pytest.raises(ResultTooLarge):
        cache.fetch(spark.range(101))
    small = ResultCache(most_bytes=500)
    for least in (0, 2, 4):
        small.fetch(ask(least))
    assert len(small) == 1 and small.fetch(ask(4)).num_rows == 47 and small.fetched == 3


def test_readers_get_bounded_rows_in_bounded_time(spark):
    catalog = serving.PublicCatalog({"v_feed_depth": spark.range(20), "secret": spark.range(1)}, ResultCache(most_rows=10))
    assert catalog.fetch("v_feed_depth", lambda v: v.filter("id < 5")).num_rows == 5
    with pytest.raises(ResultTooLarge):
        catalog.fetch("v_feed_depth")
    with pytest.raises(PermissionError):
        catalog.fetch("secret")


def test_csv_export(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'said "hi", twice', ["a", "b"]), (2, None, []), (3, "line\nbreak", None)], "id int, title string, skills array<string>")
    serving.write_csv(rows.orderBy("id"), str(tmp_path / "out"), most=3)
    (file,) = Path(tmp_path, "out").glob("*.csv")
    with file.open(newline="") as f:
        assert list(csv.reader(f)) == [["id", "title", "skills"], ["1", 'said "hi", twice', "a; b"], ["2", "", ""], ["3", "line\nbreak", ""]]


def test_functions_in_sql(spark):
    sqlfunctions.register(spark)
    observed = spark.createDataFrame([("a", [1, 2, 2, 3, 4, 5], [True, True, False, True, False, True]), ("b", [7], [False]), ("c", [], [])], "g string, d array<int>, e array<boolean>")
    got = spark.sql("SELECT g, k.* FROM {t}, LATERAL km_survival(d, e) AS k", t=observed)
    rows = lambda df: sorted((r.g, r.t, r.at_risk, r.n_events, round(r.survival, 9)) for r in df.collect())
    assert rows(got) == rows(stats.km_arrays(observed, ["g"], "d", "e")) and len(rows(got)) == 6
    k, n = F.lit(5), F.lit(10)
    row = spark.sql("SELECT wilson_low(5, 10) AS low, wilson_high(5, 10) AS high, wilson_low(1, 0) AS none, date_key(DATE'2026-02-03') AS day, classify_category('Chef', NULL) AS title, classify_category(NULL, 'ICT') AS field").first()
    want = spark.range(1).select(stats.wilson_low(k, n).alias("low"), stats.wilson_high(k, n).alias("high")).first()
    assert (round(row.low, 12), round(row.high, 12)) == (round(want.low, 12), round(want.high, 12)) and row.none is None
    assert (row.day, row.title, row.field) == (20260203, "Hospitality & Tourism", "Software & IT") and classify.OTHER == "Other"
