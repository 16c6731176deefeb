"""Leases, fenced publishing, checks observed while a table is written, time limits."""

import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lease, merge
from tidemark.plans import daily, quality


def test_one_writer_at_a_time(spark, tmp_path):
    now, folder = [100.0], str(tmp_path)
    take = lambda owner: lease.take(spark, folder, owner, 10, lambda: now[0])
    first = take("first")
    assert first.fence == 1 and take("second") is None
    now[0] = 109.0
    first.renew(10)
    now[0] = 115.0
    assert take("second") is None
    now[0] = 120.0
    second = take("second")
    assert second.fence == 2
    with pytest.raises(lease.LeaseLost):
        first.check()
    with pytest.raises(lease.LeaseLost):
        first.renew(10)
    first.release()  # changes nothing: the lease is the second's
    assert take("third") is None
    second.release()
    third = take("third")
    assert third.fence == 3 and not third.files.write("000000000003.json", {"owner": "late", "until": 9e9}, replace=False)
    third.check()


def test_an_overtaken_writer_does_not_publish(spark, tmp_path):
    now, root = [0.0], str(tmp_path / "layer")
    slow = lease.take(spark, root, "slow", 10, lambda: now[0])
    merge.publish({"t": spark.range(1)}, root, slow)
    now[0] = 11.0
    fast = lease.take(spark, root, "fast", 10, lambda: now[0])
    merge.publish({"t": spark.range(2)}, root, fast)
    with pytest.raises(lease.LeaseLost):
        merge.publish({"t": spark.range(3)}, root, slow)
    assert merge.read_current(spark, root, "t").count() == 2
    # a pointer that a sleeping writer got out all the same has the lower fence
    late = spark.range(1).select(F.lit("v=late").alias("version"), F.current_timestamp().alias("published_at"), F.lit(1).cast("long").alias("fence"))
    late.write.mode("append").parquet(f"{root}/_current")
    assert merge.read_current(spark, root, "t").count() == 2


def test_a_source_is_read_by_one_run(spark, tmp_path):
    lake = daily.Lake(spark, str(tmp_path))
    with lease.held(spark, f"{lake.root}/_sources/myjobmag", "another run") as own:
        assert own is not None and daily.run_source(lake, "myjobmag", None, None)["status"] == "busy"
    with lease.held(spark, f"{lake.root}/clean", "another run"), pytest.raises(daily.RunFailed):
        daily._publish(lake, "clean", {"job_postings": spark.range(1)}, None)


def test_checks_are_measured_by_the_write(spark, tmp_path):
    """The rows are worked out once, by the write; a check that Spark cannot plan fails alone."""
    rows = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        rows.add(1)
        return x

    table = spark.range(0, 100, 1, 3).select(counted("id").alias("a"), F.when(F.col("id") % 4 > 0, F.col("id")).alias("b"))
    checks = [
        quality.not_null("x.t", "a"), quality.not_null("x.t", "b", max_fraction=0.3), quality.expression_is_true("x.t", "b < 50", "b_is_low"), quality.row_count_between("x.t", 1, 50),
        quality.expression_is_true("x.t", "none = 1", "broken"),
    ]
    watch = quality.Watch(checks)
    merge.publish({"t": table}, str(tmp_path), write=lambda name, df, path: watch.write("x.t", df, path))
    known = watch.measures
    assert rows.value == 100 and len(known) == 4
    got = quality.run_checks(checks, {"x.t": merge.read_current(spark, str(tmp_path), "t")}, known=known)
    assert [(r.violations, r.total, r.passed) for r in got] == [(0, 100, True), (25, 100, True), (38, 100, False), (1, 1, False), (0, 0, False)]
    assert rows.value == 100 and got[1].detail == "25 of 100 violate, 30% may" and "did not run" in got[4].detail
    assert [(r.violations, r.total) for r in quality.run_checks(checks[:4], {"x.t": merge.read_current(spark, str(tmp_path), "t")})] == [(r.violations, r.total) for r in got[:4]]


def test_a_table_is_written_though_its_checks_break(spark, tmp_path):
    table = spark.range(10).select("id", F.lit("x").alias("text"))
    watch = quality.Watch([quality.expression_is_true("x.t", "cast(text AS int) = 1", "breaks_at_run_time")])
    merge.publish({"t": table}, str(tmp_path), write=lambda name, df, path: watch.write("x.t", df, path))
    read = merge.read_current(spark, str(tmp_path), "t")
    result = quality.run_checks(watch.checks, {"x.t": read}, known=watch.measures)[0]
    assert read.count() == 10 and not result.passed and "did not run" in result.detail


def test_a_slow_check_fails_alone(spark):
    @F.udf("long")
    def slow(x):
        time.sleep(60)
        return x

    tables = {"x.t": spark.range(3), "x.s": spark.range(1).select(slow("id").alias("id"))}
    never = quality.custom("x.never", "x", lambda t: t["x.s"].agg(F.sum("id").alias("violations"), F.count("*").alias("total")))
    checks = [quality.not_null("x.s", "id"), never, quality.not_null("x.t", "id")]
    began = time.time()
    got = quality.run_checks(checks, tables, seconds=3)
    assert [r.passed for r in got] == [False, False, True] and "TooSlow" in got[0].detail and "TooSlow" in got[1].detail
    assert time.time() - began < 40 and spark.range(5).count() == 5
