"""Statistics: score intervals and survival curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Z = 1.96  # 95 %


def _wilson(k: Column, n: Column, sign: int) -> Column:
    k, n = k.cast("double"), n.cast("double")
    p = k / n
    spread = F.lit(Z) * F.sqrt(p * (1 - p) / n + F.lit(Z * Z) / (4 * n * n))
    return ((p + F.lit(Z * Z) / (2 * n)) + sign * spread) / (1 + F.lit(Z * Z) / n)


def wilson_low(k: Column, n: Column) -> Column:
    """Lower end of the score interval of k successes in n; null without trials."""
    return F.when(n > 0, F.greatest(F.lit(0.0), _wilson(k, n, -1)))


def wilson_high(k: Column, n: Column) -> Column:
    return F.when(n > 0, F.least(F.lit(1.0), _wilson(k, n, 1)))


def km_survival(observed: DataFrame, by: list[str], duration: str, event: str) -> DataFrame:
    """Product-limit survival per group: t, at_risk, n_events, survival.

    Subjects are first counted per duration, so the windows run over distinct durations only.
    A step never reaches zero: its factor is at least 1e-9.
    """
    steps = observed.groupBy(*by, F.col(duration).alias("t")).agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col(event)).alias("n_events"))
    later = Window.partitionBy(*by).orderBy(F.col("t").desc()).rowsBetween(Window.unboundedPreceding, 0)
    until = Window.partitionBy(*by).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    factor = F.log(F.greatest(1 - F.col("n_events") / F.col("at_risk"), F.lit(1e-9)))
    return steps.withColumn("at_risk", F.sum("c").over(later)).withColumn("survival", F.exp(F.sum(factor).over(until))).select(*by, "t", "at_risk", "n_events", "survival")


def km_arrays(df: DataFrame, by: list[str], durations: str, events: str) -> DataFrame:
    """The same from two parallel arrays per row, as a table function takes them."""
    zipped = df.select(*by, F.inline(F.arrays_zip(F.col(durations).alias("d"), F.col(events).alias("e"))))
    return km_survival(zipped, by, "d", "e")
