"""The log-frequency filter: broadcast or probed slice by slice, the scores are the same."""

import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import _exchange, language, scoring

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_probes_that_travel_give_the_same_scores(spark, monkeypatch):
    monkeypatch.setattr(_exchange.measured, "__defaults__", (1 << 16,))  # several blocks and ranges
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None), (9001, ""), (9002, "never seen before anywhere"), (9002, "never seen before anywhere")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(odd)
    held = F.pmod(language.crc_of(docs["doc_id"]), F.lit(10)) == 0
    sent, travelled = scoring.score(docs, held), scoring.score(docs, held, most_broadcast=0)
    got = rows(sent)
    assert got == rows(travelled) and len(got) == 204 and all(math.isfinite(r[-1]) and r[-1] <= 0 for r in got)
    nothing = docs.limit(0)
    assert scoring.score(nothing, F.lit(False), most_broadcast=-1).count() == 0
    untrained = scoring.score(odd, F.lit(True), most_broadcast=-1)
    assert rows(untrained) == rows(scoring.score(odd, F.lit(True))) and {r.n_known for r in untrained.collect()} == {0}


def test_slices_err_upward_and_seldom():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 48, 20_000, dtype=np.uint64))
    counts = rng.integers(1, 200, len(keys))
    held = scoring.build_slice(keys, counts, scoring.PAIRS, 10)
    levels = held.levels(keys)
    assert (levels >= scoring.level(counts)).all() and (levels > scoring.level(counts)).mean() < 0.03
    others = np.setdiff1d(rng.integers(0, 1 << 48, 20_000, dtype=np.uint64), keys)
    assert (held.levels(others) > 0).mean() < 0.03
