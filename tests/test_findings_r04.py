"""Tests for the findings of round 4."""

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import SF

from tidemark.llm import _bytes, _exchange, scoring
from tidemark.sources import pages


def test_articles_and_labels_keep_their_whole_text(spark):
    """Texts of any length, to their last word: neither the body of an article nor the value of a label is cut."""
    long, wide = "word " * 4_000, "v" * (1 << 21)
    article = f"<article><h1>2 Vacancies Open At Acme</h1><p>{long}</p><p>Location: Nakuru Employment Type: Casual Application Deadline: 5 March 2026</p><p>the end</p></article>"
    labelled = f"<h1>Cook at {wide}</h1><a href='/jobs-at/x'>View Jobs at {wide}</a><p>Salary Range {wide} end</p>"
    df = spark.createDataFrame([("article", article), ("labelled", labelled)], "style string, html string").withColumn("url", F.lit("u"))
    posting = lambda style: json.loads(pages.page_records(df.filter(F.col("style") == style), style=style).select(F.to_json("record")).first()[0])["job_posting"]
    found = posting("article")
    assert found["description"] == f"2 Vacancies Open At Acme {long}Location: Nakuru Employment Type: Casual Application Deadline: 5 March 2026 the end"
    assert (found["jobLocation"]["address"]["addressLocality"], found["employmentType"], found["validThrough"]) == ("Nakuru", "Casual", "2026-03-05")
    found = posting("labelled")
    assert (found["title"], found["hiringOrganization"]["name"], found["salaryText"]) == ("Cook", wide, f"{wide} end")


def test_slices_are_probed_once_for_all_blocks(monkeypatch):
    """A small look-up for each block and slice costs more than its n-grams; over all blocks together it is one."""
    keys = np.arange(1, 3000, dtype=np.uint64) << np.uint64(30)
    made = scoring.build_slice(keys[::2], np.arange(1, len(keys[::2]) + 1), scoring.PAIRS, 64)
    asked = [(b, keys[b % 7 :: 3]) for b in range(50)]
    probes = pa.Table.from_pylist([{"p": 0, "kind": 1, "block": b, "keys": _bytes.pack(k), "counts": None} for b, k in asked], schema=_exchange.request_table([]).schema)
    slices = pa.table({"kind": pa.array([1], pa.int32()), "p": pa.array([0], pa.int32()), "payload": pa.array([made.flags.tobytes()]), "bits": [made.bits]})
    calls, levels = [], scoring.Slice.levels
    monkeypatch.setattr(scoring.Slice, "levels", lambda self, k: calls.append(len(k)) or levels(self, k))
    got = scoring._probed(probes, slices).to_pylist()
    assert calls == [len(keys)] and [x["block"] for x in got] == list(range(50))
    assert all((_bytes.unpack_counts(x["payload"]) == levels(made, k)).all() for x, (_, k) in zip(got, asked, strict=True))


def test_rows_between_blocks_and_ranges_stay_few(spark, monkeypatch):
    """Four times the text must not be sixteen times the rows of a size that packing dominates."""
    monkeypatch.setattr(_exchange.measured, "__defaults__", (1 << 12,))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, whole = [], scoring.materialise
    monkeypatch.setattr(scoring, "materialise", lambda df, name: kept.append(whole(df, name)) or kept[-1])
    assert scoring.score(docs, F.lit(False)).count() == docs.count()
    pieces = _exchange.measured(docs, "text")[1]
    assert pieces > 100 and kept[0].filter("block IS NOT NULL").count() <= (pieces // 2 + 1) * (pieces // 16 + 1)
