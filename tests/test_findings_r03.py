"""Tests for the findings of round 3."""

import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF

from tidemark import cleaning_catalog, raw_catalog
from tidemark.functions import geo
from tidemark.llm import _bytes, packing
from tidemark.llm.queries import vocabulary
from tidemark.sources import adapters, pages


def test_curves_in_sql_do_not_depend_on_the_order_of_rows(spark):
    """The row before LATERAL is worked out twice, from rows that arrive in another order each time."""
    i = F.col("id")
    rows = spark.range(2000).select((i % 3).cast("string").alias("source"), (i % 31).cast("int").alias("duration_days"), (i % 2 == 0).alias("left_listing"))
    shuffled = rows.repartition(6).mapInPandas(lambda parts: (p.sample(frac=1) for p in parts), rows.schema)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert raw_catalog.curves_in_sql(spark, shuffled).count() == 93
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_adapters_open_a_payload_once(spark):
    """Every look at the payload walks all of it: a source takes its fields in one pass, from as many tasks as there are cores."""
    rows = spark.createDataFrame([("myjobmag", "{}")], "source string, json string").select("source", F.parse_json("json").alias("payload"))
    plan = adapters.adapt(rows)._jdf.queryExecution().analyzed().toString()
    assert plan.count("payload#") < 25
    assert raw_catalog._orders(spark, SF).rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_pages_composed_from_a_small_file_are_many_tasks(spark):
    assert raw_catalog._customers(spark, SF).rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_pages_reach_python_a_hundred_at_once(spark):
    """Arrow's batches count rows: ten thousand pages of any size at once."""
    rows = spark.createDataFrame([("<h1>x</h1>",)], "html string")
    plan = rows.select(pages.page_parts("html").alias("p"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "Arrow" not in plan


def test_bridge_does_without_the_columns_of_the_fact(spark):
    """Companies and counts of skills join the fact from the left; the bridge needs neither."""
    bridge = cleaning_catalog._load(spark, SF)["bridge"]
    assert "LeftOuter" not in bridge._jdf.queryExecution().optimizedPlan().toString()


def test_orders_as_postings_are_many_tasks(spark):
    assert raw_catalog.posted(spark, SF).rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_words_are_not_encoded_one_by_one():
    """Plain letters skip the tokenizer's steps, and other new words of a call share one encoding."""
    encoder, tokenizer = packing.WordEncoder(vocabulary("word_bpe_49k.json")), Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    made = []

    class Counted:
        model = encoder.tokenizer.model

        def __getattr__(self, name):
            def run(texts, **options):
                made.append(1 if name == "encode" else len(texts))
                return getattr(tokenizer, name)(texts, **options)

            return run

    encoder.tokenizer = Counted()
    texts = [f"wort{chr(97 + i % 26)}{chr(0xDF + i % 33)} Straße{i}x don't{i} {chr(0x3B1 + i % 20)}x, e\u0301t\u00e9 ÷{i}÷" for i in range(600)] + ["", "ÀÉ àé"]
    got = [list(ids) for chunk in _bytes.chunks(pa.array(texts)) for ids in encoder.rows(chunk)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)] and sum(made) <= 2


def test_columns_of_a_posting_are_worked_out_apart(spark):
    """A column that nobody asks for costs nothing, and plain fields take no steps of arrays: those are interpreted."""
    plan = adapters.adapt(raw_catalog.posted(spark, SF)).select("title", "date_posted")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "lambda" not in plan.split("try_variant_get")[0]
    rows = [("jooble", '{"job": {"title": "[Remote] Cook", "company": {"a": 1}, "location": " x ", "type": ["b"], "salary": "{5}"}}'), ("reliefweb", '{"job": {"title": "Cook", "source": [{"name": {"z": 1}}, 3, {"name": "[A] "}]}}')]
    got = adapters.adapt(spark.createDataFrame(rows, "source string, json string").select("source", F.parse_json("json").alias("payload"))).collect()
    assert [got[0][c] for c in ("title", "company", "location_text", "employment_type", "salary_text")] == ["[Remote] Cook", None, "x", None, "{5}"] and got[1]["company"] == "[A]"


def test_places_of_ascii_texts_are_found_in_one_look(spark):
    texts = ["Kenya, Upper-Hill; Mombasa", "Remote - work, from home", "Murang'a County", "Köln｜Embu", "x|Nairobi West", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r[0]) for r in df.select(geo.map_location(F.col("t"))).collect()]
    assert [g[0] for g in got] == ["Nairobi", None, "Murang'a", "Embu", "Nairobi", None] and [g[2] for g in got] == [False, True, False, False, False, False]
    marked = [r[0] for r in df.select(geo.marked_location(F.col("t"))).collect()]
    assert marked[0] == "kenya| upper hill| mombasa" and marked[3] is None
