"""Operator 13: fill-in-middle transformation by a matcher that goes over each text twice.

A text is a row of units: a word with the space before it, or the space at the end. The first pass
counts the units. The second advances a lazy match iterator to the two ranks that the document's
hash draws from 0 to that count, and keeps only where it stands there. No unit is ever stored, so a
task holds one batch of texts and two numbers for each, however many units they have; texts that
stay plain are passed once.

Only the two places leave the Python worker; texts are cut, joined and digested by Spark's own functions.

Defined cases: a null text counts as empty, and an empty one stays plain, as does one that holds a
mark; a null id hashes as an empty one; rows with one id draw from the same hash; an empty table gives no rows.
Other columns are ignored by the report and returned untouched by ``transform``, whatever their names.
"""

from __future__ import annotations

import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm._tables import unused

#: Fixed value: what a unit is.
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_CUT = pa.struct([("n", pa.int64()), ("first", pa.int64()), ("second", pa.int64())])


def count_units(text: str) -> int:
    return sum(1 for _ in UNIT.finditer(text))


def place_of(text: str, low: int, high: int) -> tuple[int, int]:
    """Where the first ``low`` units end, and the first ``high``."""
    units = UNIT.finditer(text)
    first = next(islice(units, low - 1, low)).end() if low else 0
    return first, next(islice(units, high - low - 1, high - low)).end() if high > low else first


@F.arrow_udf(StructType([StructField(name, LongType()) for name in ("n", "first", "second")]))
def _cut(text: pa.Array, drawn: pa.Array, also: pa.Array, plain: pa.Array) -> pa.Array:
    counts, firsts, seconds = [], [], []
    for value, a, b, stays in zip(text, drawn, also, plain, strict=True):
        units = value.as_py()
        n = count_units(units)
        first = second = None
        if not stays.as_py():
            a, b = a.as_py() % (n + 1), b.as_py() % (n + 1)
            first, second = place_of(units, min(a, b), max(a, b))
        counts.append(n)
        firsts.append(first)
        seconds.append(second)
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(firsts, pa.int64()), pa.array(seconds, pa.int64())], fields=list(_CUT))


def _formed(df: DataFrame, key: Column, text: Column, seed: int, rate: int, spm_rate: int, names: list[str]) -> DataFrame:
    """``df`` with the columns ``names``: n, form, prefix_chars, middle_chars, output."""
    body = F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    draw = lambda i: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(body, F.lit(mark))
    plain = (body == "") | marked | (draw(2) % 100 >= rate)
    form = F.when(plain, F.lit("plain")).when(draw(3) % 100 < spm_rate, F.lit("spm")).otherwise(F.lit("psm"))
    at, n, shape, before, middle, output = (unused(df, name) for name in ("cut_at", *names))
    cut = df.withColumn(at, _cut(body, draw(0), draw(1), plain)).withColumn(shape, form)
    first, second = F.col(f"{at}.first"), F.col(f"{at}.second")
    parts = {"P": F.substring(body, F.lit(1), first.cast("int")), "M": F.substring(body, (first + 1).cast("int"), (second - first).cast("int")), "S": F.substring(body, (second + 1).cast("int"), F.length(body))}
    joined = lambda order: F.concat(*[x for letter in order for x in (F.lit({"P": PREFIX, "S": SUFFIX, "M": MIDDLE}[letter]), parts[letter])])
    written = F.when(F.col(shape) == "plain", body).when(F.col(shape) == "spm", joined("SPM")).otherwise(joined("PSM"))
    return cut.select(*[cut[c] for c in df.columns], F.col(f"{at}.n").alias(n), shape, first.alias(before), (second - first).alias(middle), written.alias(output))


_NAMES = ["n", "form", "prefix_chars", "middle_chars", "output"]


def restored(output: Column, form: Column) -> Column:
    """The text that an output of that form was made from."""
    parts = F.split(output, "|".join(re.escape(m) for m in (PREFIX, SUFFIX, MIDDLE)))
    part = lambda i: F.get(parts, i)
    return F.when(form == "plain", output).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(F.concat(part(1), part(3), part(2)))


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """One row per row of ``df``: doc_id, n (units), form (plain, psm or spm), prefix_chars,
    middle_chars (null if plain), output (the text as training reads it)."""
    rows = df.select(df[key].alias("doc_id"), df[text].alias("body"))
    return _formed(rows, F.col("doc_id"), F.col("body"), seed, rate, spm_rate, _NAMES).drop("body")


def transform(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with its texts in their new form."""
    output = unused(df, "output")
    options = {"seed": 42, "rate": 50, "spm_rate": 80} | options
    formed = _formed(df, df[key], df[text], names=_NAMES, **options)
    return formed.select(*[F.col(output).alias(c) if c == text else F.col(f"`{c}`") for c in df.columns])


def report(formed: DataFrame) -> DataFrame:
    """Rows of ``fill_in_middle`` with digests of the output and of the text restored from it."""
    back = restored(F.col("output"), F.col("form"))
    return formed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))
