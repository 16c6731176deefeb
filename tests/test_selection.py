"""Exact percentiles by narrowing, against the built-in ones."""

from pyspark.sql import functions as F

from tidemark.operators import selection

FRACTIONS = {"least": 0.0, "low": 0.25, "middle": 0.5, "high": 0.9, "most": 1.0}


def both(rows, by, **options):
    exact = rows.groupBy(*by).agg(*[F.percentile(F.col("v").cast("double"), p).alias(n) for n, p in FRACTIONS.items()])
    keep = [*by, *FRACTIONS]
    plain = lambda df: sorted((tuple(r) for r in df.select(*keep).collect()), key=str)
    return plain(selection.percentiles(rows, by, F.col("v"), FRACTIONS, **options)), [r for r in plain(exact) if r[-1] is not None]


def test_percentiles_of_large_groups(spark):
    n = F.col("id")
    spread = F.when(n % 7 == 0, F.lit(1e300)).when(n % 7 == 1, F.lit(5.0)).otherwise(F.pow(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 1000.0, 3))
    group = F.when(n % 5 == 0, None).when(n % 3 == 0, "third").when(n % 1000 == 1, "few").when(n % 1000 == 2, "empty").otherwise("rest")
    rows = spark.range(20_000).select(group.alias("g"), F.when(group == "empty", None).otherwise(spread).alias("v"))
    got, want = both(rows, ["g"], most=40, parts=8)
    assert got == want and len(got) == 4
    got, want = both(rows, [], most=40, parts=8)
    assert got == want and len(got) == 1


def test_ranks_beside_ties(spark):
    """A value that most rows repeat, with the wanted ranks on it, at its ends and beyond it."""
    for heavy in (5_000, 5_001):
        rows = spark.range(10_000).select(F.lit("a").alias("g"), F.when(F.col("id") < heavy, 7).otherwise(F.col("id") + 10).alias("v"))
        got, want = both(rows, ["g"], most=20, parts=16)
        assert got == want


def test_small_groups_take_the_built_in(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), (None, 4.0)], "g string, v double")
    got, want = both(rows, ["g"])
    assert got == want and len(got) == 2
    assert selection.percentiles(rows.limit(0), ["g"], F.col("v"), FRACTIONS).count() == 0
