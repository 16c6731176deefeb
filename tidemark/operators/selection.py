"""Exact percentiles of groups of any size.

The built-in exact percentile holds a group's distinct values in one task. Here a group of more than
``most`` values is narrowed instead: marks at even ranks are estimated by a sketch that tasks merge,
the values below, at and between the two marks around the wanted rank are counted exactly, and only
those between them stay candidates. A rank that falls on a mark ends there, so a value that a third
of the rows repeat is no obstacle; every other round leaves a few parts in ``parts`` of the
candidates. What is at most ``most`` candidates is picked from in order. Rows are shuffled nowhere:
each round sends one sketch and a few counts a task and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.shared import kept

MOST_BROADCAST = 50_000


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for x in conditions[1:]:
        out = out & x
    return out


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def _of(values: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """The values of each wanted rank that are still candidates for it."""
    state = _few(state)
    inside = (values["v"] >= state["lo"]) & (values["v"] <= state["hi"])
    return values.join(state, _all([inside, *[values[c].eqNullSafe(state[c]) for c in by]])).select(*[state[c] for c in state.columns], "v")


def _narrowed(values: DataFrame, state: DataFrame, by: list[str], parts: int) -> DataFrame:
    """The state after one round; ``low`` and ``high`` are filled where the rank has been found."""
    known = state.columns
    sketch = F.percentile_approx("v", F.array(*[F.lit(i / parts) for i in range(parts + 1)]), F.lit(20 * parts))
    marked = _of(values, state, by).groupBy(*known).agg(sketch.alias("marks"))
    step = (F.col("rank") - F.col("below")) / F.col("m") * parts
    mark = lambda i: F.get("marks", F.greatest(F.lit(0), F.least(F.lit(parts), i)).cast("int"))
    marked = kept(marked.withColumn("a", mark(F.floor(step) - 1)).withColumn("b", mark(F.ceil(step) + 2)).drop("marks"), "rank-marks")
    v, a, b = F.col("v"), F.col("a"), F.col("b")
    counted = _of(values, marked, by).groupBy(*marked.columns).agg(
        F.count_if(v < a).alias("under_a"), F.count_if(v <= a).alias("to_a"), F.min(F.when(v > a, v)).alias("over_a"),
        F.count_if(v < b).alias("under_b"), F.count_if(v <= b).alias("to_b"), F.max(F.when(v < b, v)).alias("before_b"),
    )
    at, also = F.col("rank") - F.col("below"), F.col("also") - F.col("below")  # places among the candidates
    on_a = (at >= F.col("under_a")) & (at < F.col("to_a"))
    on_b = (also >= F.col("under_b")) & (also < F.col("to_b"))
    up, down = at >= F.col("to_a"), also < F.col("under_b")
    columns = {
        "low": F.when(on_a, a).when(on_b, F.when(at >= F.col("under_b"), b).otherwise(F.col("before_b"))),
        "high": F.when(on_a, F.when(also < F.col("to_a"), a).otherwise(F.col("over_a"))).when(on_b, b),
        "lo": F.when(up, F.col("over_a")).otherwise(F.col("lo")),
        "hi": F.when(down, F.col("before_b")).otherwise(F.col("hi")),
        "below": F.col("below") + F.when(up, F.col("to_a")).otherwise(0),
        "m": F.when(down, F.col("under_b")).otherwise(F.col("m")) - F.when(up, F.col("to_a")).otherwise(0),
    }
    return counted.select(*[columns.get(c, F.col(c)).alias(c) for c in known])


def _picked(values: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """The ranks of few candidates, out of all of those in order."""
    found = _of(values, state, by).groupBy(*state.columns).agg(F.sort_array(F.collect_list("v")).alias("all"))
    at = lambda c: F.get("all", (F.col(c) - F.col("below")).cast("int"))
    return found.select(*[{"low": at("rank"), "high": at("also")}.get(c, F.col(c)).alias(c) for c in state.columns])


def _between(low: Column, high: Column, place: Column) -> Column:
    """What stands at a fractional place between two ranks."""
    lower, upper = F.floor(place), F.ceil(place)
    return F.when((lower == upper) | (low == high), low).otherwise((upper - place) * low + (place - lower) * high)


def percentiles(rows: DataFrame, by: list[str], value: Column, fractions: dict[str, float], most: int = 100_000, parts: int = 64, stored: bool = False) -> DataFrame:
    """``by`` and a column for each named fraction: the value at that fraction of each group's
    non-null values, in between two of them linearly. Groups without a value have no row. ``rows`` are
    read several times, so they are written first unless they are ``stored``."""
    values = rows.select(*by, value.cast("double").alias("v")).filter("v IS NOT NULL")
    values = values if stored else kept(values, "rank-values")
    sizes = values.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    exact = [F.percentile("v", p).alias(name) for name, p in fractions.items()]
    if (sizes.agg(F.max("n")).first()[0] or 0) <= most:
        small = values.groupBy(*by).agg(*exact, F.count(F.lit(1)).alias("n"))
        return small.filter("n > 0").drop("n")
    large = kept(sizes.filter(F.col("n") > most), "large-groups")
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in fractions.items()]))
    state = large.withColumn("want", wanted).select(*by, "n", "want.*", "lo", "hi").withColumn("place", F.col("p") * (F.col("n") - 1))
    none = F.lit(None).cast("double")
    state = state.select(*by, "name", "place", F.floor("place").alias("rank"), F.ceil("place").alias("also"), "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("m"), none.alias("low"), none.alias("high"))
    state, done = kept(state, "rank-state"), None
    for _ in range(64):
        still = (F.col("m") > most) & F.col("low").isNull()
        ready = _settled(values, state.filter(~still), by)
        done = ready if done is None else done.unionByName(ready)
        state = state.filter(still)
        if state.isEmpty():
            break
        state = kept(_narrowed(values, state, by, parts), "rank-state")
    else:
        raise RuntimeError("ranks were not found in 64 rounds")
    found = done.withColumn("x", _between(F.col("low"), F.col("high"), F.col("place")))
    found = found.groupBy(*by).agg(*[F.max(F.when(F.col("name") == name, F.col("x"))).alias(name) for name in fractions])
    if not by:
        return found
    small = values.join(large.select(*[F.col(c).alias(f"large_{c}") for c in by]), _all([values[c].eqNullSafe(F.col(f"large_{c}")) for c in by]), "left_anti")
    return small.groupBy(*by).agg(*exact).unionByName(found)


def _settled(values: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """Ranks that were found on a mark, and those of few candidates."""
    return state.filter("low IS NOT NULL").unionByName(_picked(values, state.filter("low IS NULL"), by))
