"""A training corpus from ``documents``: identify languages, drop exact and near copies, mix the
sources to target weights, pack into sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; all but
the last return the columns of ``documents``. The mix repeats documents of sources that fall short
of their target, so the packed result may hold a document twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, language, minhash, mixing, packing
from tidemark.llm._tables import materialise, read_table
from tidemark.llm.queries import vocabulary


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and texts no language of which has half of the letters."""
    model = language.train(docs.filter(F.pmod(language.crc_of(F.col("doc_id")), F.lit(4)) != 2))
    return language.keep_identified(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; a test runs them all and holds them against plain Python, near dedup
#: against the report of its operator, which has a brute-force test of its own.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
