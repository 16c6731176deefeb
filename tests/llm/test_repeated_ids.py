"""Rows that share their ids: nothing is lost, nothing is linked falsely, reruns agree."""

from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import embeddings, lines, mixing

SCHEMA = "doc_id long, text string, source string, kept boolean"


def table(spark, rows):
    return spark.createDataFrame([(*r, True) for r in rows], SCHEMA)


def test_lines_of_rows_that_share_an_id_stay(spark):
    first, other = "The very first line of all of them", "Quite another text without any twin"
    rows = [(1, first, "a"), (5, first, "a"), (5, other, "a"), (None, other + " here", "a"), (None, "Alone among the nameless rows", "a")]
    got = Counter((r.doc_id, r.text) for r in lines.dedup_lines(table(spark, rows)).collect())
    assert got == Counter([(1, first), (5, ""), (5, other), (None, other + " here"), (None, "Alone among the nameless rows")])
    near = [(2, "A line that is near to another one", "a"), (7, "A line that is near to another one.", "a"), (7, "A line of its own beside the near one", "a"), (7, "A line of its own beside the near one", "a")]
    got = Counter((r.doc_id, r.text) for r in lines.dedup_lines(table(spark, near)).collect())
    assert got == Counter([(2, near[0][1]), (7, ""), (7, near[2][1]), (7, near[2][1])])


def test_vectors_that_share_an_id_are_apart(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, [0.05, 1.0]), (4, [-1.0, 0.0]), (4, [-1.0, 0.0])]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(1, 0, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 1, 4, True), (4, 1, 4, True)]


def test_mixes_agree_whatever_the_order_of_the_rows(spark):
    words = lambda n: " ".join(["word"] * n)
    rows = [(i % 5, words(1 + i % 9) + f" {i % 7}", f"s{i % 3}") for i in range(120)] + [(3, "said often", "s1")] * 60 + [(3, "said often", "s2")] * 10 + [(None, None, "s0")] * 3
    seen = set()
    for turn in range(3):
        shuffled = sorted(rows, key=lambda r: hash((turn, str(r))))
        df = table(spark, shuffled).repartition(1 + turn)
        plan = Counter((r.doc_id, r["size"], r.source_size, r.taken) for r in mixing.mix_plan(df, bucket_rows=8).collect())
        mixed = Counter((r.doc_id, r.text, r.source) for r in mixing.mix(df, bucket_rows=8).collect())
        assert sum(plan.values()) == len(rows) and sum(k[3] * n for k, n in plan.items()) == sum(len((t or "").split()) * n for (_, t, _), n in mixed.items())
        assert all(n <= 2 * rows.count(k) for k, n in mixed.items())
        seen.add((frozenset(plan.items()), frozenset(mixed.items())))
    assert len(seen) == 1
    copies = mixing.mix(table(spark, rows), bucket_rows=8).groupBy("doc_id", "text", "source").agg(F.count("*").alias("n"))
    assert copies.filter("n > 120").isEmpty()
