"""Corpus operators against brute force, and their defined cases: nulls, empty tables, ties,
repeated rows, very long texts and clashing extra columns."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import _bytes, components, embeddings, exact_dedup, language, licenses, lines, minhash, mixing, packing, scoring, secrets
from tidemark.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, bucket string, node long"
LONG = "word " * 30000
ROWS = [
    (1, "Same text here", "en", "b", 1, True, "x", 1),
    (2, "SAME text here", "en", "b", 1, True, "x", 1),
    (3, "", "en", None, None, None, None, None),
    (4, None, None, "a", None, None, None, None),
    (5, LONG, "en", "a", None, None, None, None),
    (6, "ÄB same", "de", "c", None, None, None, None),
    (7, "äB same", "de", "c", None, None, None, None),
    (None, "Same text here", "en", "c", None, None, None, None),
    (8, "Repeated row text", "en", "a", None, None, None, None),
    (8, "Repeated row text", "en", "a", None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, none):
    got = exact_dedup.exact_dedup_report(docs, salts=3).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 10 and by[1]["keep_id"] == 2 and by[1]["group_size"] == 3 and by[2]["kept"] and not by[1]["kept"] and not by[None]["kept"]
    assert by[3]["keep_id"] == 4 and by[6]["kept"] and by[7]["kept"] and by[8]["group_size"] == 2
    stays = exact_dedup.exact_dedup(docs)
    assert stays.columns == docs.columns and sorted(r["doc_id"] for r in stays.collect()) == [2, 4, 5, 6, 7, 8]
    assert exact_dedup.exact_dedup_report(none).count() == 0


def test_mixing(docs, none):
    plan = mixing.mix_plan(docs).collect()
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in ROWS]
    assert sorted(r["size"] for r in plan) == sorted(sizes) and all(r["taken"] <= 2 * r["size"] for r in plan)
    assert sum(r["taken"] for r in plan) <= 1.5 * sum(sizes) and abs(sum({r["source_size"]: r["target"] for r in plan}.values()) - 1.5 * sum(sizes)) < 1
    assert mixing.mix(docs.filter("doc_id < 8")).columns == docs.columns
    assert mixing.mix_plan(none).count() == 0


def test_null_and_repeated_ids_neither_multiply_nor_lose_rows(spark):
    rows = [(None, f"text {i} of many", "s") for i in range(6)] + [(7, "one more text", "s"), (7, "another text of seven", "s"), (8, "ONE more text", "s")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = Counter(r["text"] for r in mixing.mix(table).collect())
    plan = mixing.mix_plan(table).agg(F.sum("copies")).first()[0]
    assert sum(mixed.values()) == plan and max(mixed.values()) <= 2
    stays = Counter((r["doc_id"], r["text"]) for r in exact_dedup.exact_dedup(table).collect())
    assert stays == Counter([*[r[:2] for r in rows[:6]], rows[7][:2], rows[8][:2]])
    words = " ".join(f"w{i}" for i in range(60))
    near = [(1, words, "s"), (7, f"{words} end", "s"), (7, "quite another text", "s"), (None, f"{words} finish", "s"), (9, "row that stands twice", "s"), (9, "row that stands twice", "s"), (None, "nameless", "s"), (None, "Nameless", "s")]
    stays = Counter((r["doc_id"], r["text"]) for r in minhash.near_dedup(spark.createDataFrame(near, "doc_id long, text string, source string")).collect())
    assert set(stays) - {(None, "nameless"), (None, "Nameless")} == {near[0][:2], near[2][:2], near[4][:2]} and sum(stays.values()) == 4
    exact = [(1, "alpha", "s"), (1, "beta", "s"), (2, "Alpha", "s"), (2, "Alpha", "t"), (None, "gamma", "s"), (None, "Gamma", "s"), (None, "BETA", "s")]
    stays = sorted((r["doc_id"] or 0, r["text"].lower()) for r in exact_dedup.exact_dedup(spark.createDataFrame(exact, "doc_id long, text string, source string")).collect())
    assert stays == [(0, "gamma"), (1, "beta"), (2, "alpha")]
    twice = spark.createDataFrame([(5, "same row", "s")] * 3 + [(6, "other row", "t")], "doc_id long, text string, source string")
    assert max(Counter(r["text"] for r in mixing.mix(twice).collect()).values()) <= 6


def test_mixing_meets_its_targets(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 5}" if i % 3 else "s0") for i in range(3000)]
    plan = mixing.mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string"), bucket_rows=100)
    per = plan.withColumn("s", F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.col("doc_id") % 5)).groupBy("s").agg(F.sum("taken").alias("t"), F.max("target").alias("target")).collect()
    assert all(abs(r["t"] - r["target"]) <= 14 for r in per)


def test_secrets(docs, none):
    import base64
    import gzip
    import urllib.parse

    plain = 'token = "bc0a5302762f37969011b69180d661037b374f6e"'
    e = base64.b64encode(plain.encode()).decode()
    assert [(r["kind"], r["base"]) for r in secrets.scan_text(plain.encode())] == [("assign", True), ("hex", True)]
    for inner, via in ((e, "base64"), (urllib.parse.quote(e, safe=""), "base64"), (base64.b64encode(gzip.compress(plain.encode())).decode(), "gzip"), (base64.b64encode(e.encode()).decode(), "base64"), ("".join(f"\\u{ord(c):04x}" for c in plain), "unicode")):
        text = f"é {inner} end"
        found = secrets.scan_text(text.encode())
        assert found and all(not r["base"] and via in r["via"] and 2 <= r["start"] < r["end"] <= 2 + len(inner) for r in found)
    assert secrets.scan_text("secret: token = abcdef1".encode()) == []
    got = secrets.report(secrets.scan(docs)).collect()
    assert len(got) == 10 and all(r["n_assign"] == r["n_access"] == r["n_hex"] == 0 and r["spans"] == "" for r in got)
    assert secrets.report(secrets.scan(none)).count() == 0


def test_secrets_anywhere_in_nested_layers():
    import base64
    import bz2
    import gzip
    import lzma
    import textwrap
    import zlib

    plain = b'note one two three token = "bc0a5302762f37969011b69180d661037b374f6e" end of the note'
    noise = np.random.default_rng(4).integers(0, 256, 300, dtype=np.uint8).tobytes()
    b64 = lambda x: base64.b64encode(x).decode()
    wrapped = lambda x, n: "\n".join(textwrap.wrap(b64(x), n))
    cases = [wrapped(plain, 64), wrapped(plain, 20).replace("\n", "\r\n"), wrapped(gzip.compress(noise + plain), 76)]
    cases += [b64(p(b"first " * 9) + p(plain)) for p in (gzip.compress, bz2.compress, lzma.compress)]
    cases += [f"{glued}{b64(plain)}" for glued in ("/", "-", "_x", "abc")] + [b64(plain).rstrip("=") + "A" * k for k in (1, 2, 3)]
    cases += ["".join(f"{mark}{c:02x}" for c in gzip.compress(plain)) for mark in ("%", "\\x")] + [b64(b"head " + zlib.compress(plain))]
    cases.append(b64(gzip.compress(b"word " * (4 << 20) + plain)))
    for inner in cases:
        found = secrets.scan_text(f"é {inner} .".encode())
        assert {r["kind"] for r in found} >= {"assign", "hex"}, inner[:80]
        assert all(not r["base"] and 2 <= r["start"] < r["end"] <= 2 + len(inner) for r in found)


def test_secrets_in_very_long_texts():
    """One escape in a long text, and many secrets behind characters of two bytes: both in proportion to the text."""
    import time

    began = time.process_time()
    text = b"word " * 400_000 + b"token = abc%41defg " + b"more " * 1000
    found = secrets.scan_text(text)
    assert [(r["kind"], r["base"], text[r["start"] : r["end"]]) for r in found] == [("assign", False, b"token = abc%41defg")]
    many = "é token=abcdef12 " * 40_000
    found = [r for r in secrets.scan_text(many.encode()) if r["base"]]
    assert len(found) == 40_000 and all(many[r["start"] : r["end"]] == "token=abcdef12" for r in found[:: 997])
    assert time.process_time() - began < 30


def test_base_secrets_equal_plain_regular_expressions():
    rng = np.random.default_rng(1)
    parts = ["token", "API_KEY", " ", "=", ":", '"', "abcdef", "AKIA", "ABCDEFGHIJKLMNOP1234", "0123456789abcdef", "é", "ſecret", "passwd", "x"]
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for _ in range(300):
        t = "".join(parts[i] for i in rng.integers(0, len(parts), 12))
        want = {("assign", *m.span()) for m in assign.finditer(t) if len(m[2]) >= 6} | {("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20} | {("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24}
        assert {(r["kind"], r["start"], r["end"]) for r in secrets.scan_text(t.encode()) if r["base"]} == want


def test_near_duplicates(spark, docs, none):
    words = [f"w{i}" for i in range(200)]
    near = words[:100] + ["changed"] + words[101:]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words[:100])), (4, None), (5, "one two"), (6, "One  two"), (7, "")]
    got = {r["doc_id"]: r for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: r["component_id"] for k, r in got.items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7} and got[1]["component_size"] == 2 and not got[2]["kept"]
    assert minhash.near_dedup(docs).columns == docs.columns
    assert minhash.near_duplicates(none).count() == 0


def test_sampling_estimates_weighted_jaccard():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**48, 400, dtype=np.uint64)
    a, b = rng.random(400) + 0.5, rng.random(400) + 0.5
    drawn = minhash.samples(np.concatenate((keys, keys)), np.concatenate((a, b)), np.array([0, 400]), 2000)
    assert abs((drawn[0] == drawn[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_links_across_components_are_all_found():
    sets = [set(range(0, 50)), set(range(2, 52)), set(range(4, 54)), set(range(40, 90))]
    packed = [(_bytes.pack(np.array(sorted(s), dtype=np.uint64)), _bytes.pack_counts(np.ones(len(s), dtype=np.float32).view(np.uint32))) for s in sets]
    found = minhash.linked_across(np.arange(4), np.arange(4), np.zeros(4, dtype=int), np.full((4, 2), 9), 9, True, packed, 0.8)
    assert {tuple(sorted(x)) for x in found} == {(0, 1), (0, 2), (1, 2)}


def test_components(spark):
    links = [(i, i + 1) for i in range(12)] + [(20, 21), (22, 21), (30, 30)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(13)} | {20: 20, 21: 20, 22: 20}


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((30, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in base[0] + 0.05 * rng.standard_normal(16)]) for i in range(20)]
    rows += [(200, rows[1][1]), (201, None), (202, [0.0] * 16), (203, [float("nan")] * 16), (204, [None] * 16), (205, []), (None, rows[2][1])]
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    x = np.array([r[1] for r in rows[:51]], dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = ((x @ x.T) >= 0.9).sum(axis=1) - 1
    assert [got[r[0]]["n_links"] for r in rows[:51]] == want.tolist() and len(got) == len(rows)
    assert got[119]["component_id"] == 0 and got[200]["component_id"] == 1 and all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(201, 206))
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def _brute_force_lines(rows: list[tuple[int, str]], edits: int = 2, chars: int = 10) -> dict[tuple[int, int], tuple[tuple[int, int], int]]:
    """(doc_id, line_no) -> (first line of its class, number of other lines linked)."""

    def distance(a: str, b: str) -> int:
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
            last = now
        return last[-1]

    placed = {(d, i): x.strip(" \t\r\x0b\x0c") for d, t in rows for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\r\x0b\x0c")}
    texts = sorted(set(placed.values()))
    near = {x: {y for y in texts if y != x and abs(len(x) - len(y)) <= edits and distance(x, y) <= min(edits, min(len(x), len(y)) // chars)} for x in texts}
    root = {x: x for x in texts}
    for _ in texts:
        root = {x: min([root[x], *(root[y] for y in near[x])]) for x in texts}
    first: dict[str, tuple[int, int]] = {}
    for at, x in sorted(placed.items()):
        first.setdefault(root[x], at)
    return {at: (first[root[x]], len(near[x])) for at, x in placed.items()}


@pytest.mark.parametrize("hot", [1, 16])
def test_lines_equal_brute_force(spark, hot):
    """Families of lines with few and many changes, short ones too; hot=1 sends nearly all through the finer keys."""
    rng = np.random.default_rng(11)
    bases = ["Page 12 of 90 pages", "the quick brown fox jumps over the lazy dog", "ПЕРВАЯ СТРОКА О ПОГОДЕ НА СЕВЕРЕ", "0123456789", "tiny", "a much longer line that has many words, and more than one place at which it could be changed by hand"]
    rows = []
    for i in range(90):
        x = list(bases[rng.integers(len(bases))])
        for _ in range(rng.integers(0, 4)):
            at = int(rng.integers(0, len(x) + 1))
            x[at : at + int(rng.integers(0, 2))] = list(rng.choice(list("abcxyz12"), int(rng.integers(0, 2))))
        rows.append((i // 3, "".join(x)))
    texts: dict[int, list[str]] = {}
    for d, x in rows:
        texts.setdefault(d, []).append(x)
    table = [(d, "\n".join(x)) for d, x in texts.items()]
    got = lines.line_report(spark.createDataFrame(table, "doc_id long, text string"), hot=hot).collect()
    assert {(r["doc_id"], r["line_no"]): ((r["first_doc_id"], r["first_line_no"]), r["n_links"]) for r in got} == _brute_force_lines(table)
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == (r["first_doc_id"], r["first_line_no"])) for r in got)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edit_distance(spark, edits):
    rng = np.random.default_rng(edits)
    word = lambda n: "".join(rng.choice(list("abé"), n))
    pairs = []
    for _ in range(150):
        a = word(rng.integers(0, 10))
        b = list(a)
        for _ in range(rng.integers(0, 4)):
            i = rng.integers(0, len(b) + 1)
            b[i : i + rng.integers(0, 2)] = word(rng.integers(0, 2))
        pairs.append(tuple(sorted((a, "".join(b)), key=len)))
    df = spark.createDataFrame(pairs, "x string, y string").select("x", "y", lines.edit_distance(F.col("x"), F.col("y"), edits).alias("got"), F.levenshtein("x", "y").alias("want"))
    assert df.filter(f"(want <= {edits} AND got <> want) OR (want > {edits} AND got <= {edits})").count() == 0


def test_lines(spark, docs, none):
    base = "the quick brown fox jumps over the lazy dog today"
    rows = [(1, f"{base}\nshort\n\nother line that is long enough to be compared"), (2, f"{base}s\nshort"), (3, base.replace("quick", "quack") + "\nshort."), (4, None)]
    got = {(r["doc_id"], r["line_no"]): r for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1, 0]["class_id"] == got[2, 0]["class_id"] == got[3, 0]["class_id"] and [got[i, 0]["kept"] for i in (1, 2, 3)] == [True, False, False]
    assert [got[i, 0]["n_links"] for i in (1, 2, 3)] == [2, 2, 2] and not got[2, 1]["kept"] and got[3, 1]["kept"] and (1, 2) not in got
    clean = {r["doc_id"]: r["text"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert clean[2] == "" and clean[3] == "short." and clean[1] == rows[0][1] and clean[4] is None
    assert lines.dedup_lines(docs).columns == docs.columns and lines.line_report(none).count() == 0


def test_lines_that_share_bits_of_a_hash_stay_apart(spark):
    capitals = spark.range(300_000).select(F.upper(F.md5(F.col("id").cast("string"))).alias("line"))
    same = capitals.groupBy(F.shiftrightunsigned(F.xxhash64("line"), 32).alias("h")).agg(F.collect_list("line").alias("x")).filter("size(x) > 1").orderBy("h").first()["x"]
    rows = spark.createDataFrame([(i, line) for i, line in enumerate(same)], "doc_id long, text string")
    got = lines.line_report(rows).collect()
    assert len({r["class_id"] for r in got}) == len(same) and all(r["kept"] for r in got)


def test_lines_with_one_hash_are_hashed_anew(spark, monkeypatch):
    whole = lines.hashed
    monkeypatch.setattr(lines, "hashed", lambda line, salt: F.length(line).cast("long") if salt < 2 else whole(line, salt))
    a, b = "ПЕРВАЯ СТРОКА О ПОГОДЕ НА СЕВЕРЕ", "ВТОРАЯ КНИГА ИЗ ЧЕТЫРЕХ ТОМОВ 77"
    rows = [(1, f"{a}\n{b}\n{a}"), (2, b[:-1] + "8"), (3, "alone")]
    assert len(a) == len(b)
    got = {(r["doc_id"], r["line_no"]): r for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1, 0]["class_id"] == got[1, 2]["class_id"] != got[1, 1]["class_id"] == got[2, 0]["class_id"]
    assert [k for k, r in sorted(got.items()) if r["kept"]] == [(1, 0), (1, 1), (3, 0)] and got[2, 0]["n_links"] == 1


def test_scores(docs, none):
    held = F.pmod(language.crc_of(docs["doc_id"]), F.lit(10)) == 0
    got = {(r["doc_id"], r["n_tokens"]): r for r in scoring.score(docs, held).collect()}
    texts = [(r[0], re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")) + ["\0"]) for r in ROWS]
    out = lambda k: zlib.crc32(str(k if k is not None else "").encode()) % 10 == 0
    c = Counter(w for k, t in texts if not out(k) for w in t)
    n, v = sum(c.values()), len(c)
    for k, t in texts:
        r = got[k, len(t)]
        assert r["n_known"] == sum(c[w] > 0 for w in t) and r["train_tokens"] == n and math.isclose(r["base_score"], sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel_tol=1e-9) and r["score"] <= 0
    assert scoring.score(none, F.lit(False)).count() == 0


def test_scores_hold_every_pair(spark):
    rng = np.random.default_rng(9)
    texts = [[f"w{i}" for i in rng.integers(0, 60, 40)] for _ in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["score"] for r in scoring.score(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(False), bits_per_entry=64).collect()}
    framed = [[None, *t, None] for t in texts]
    words, pairs = Counter(w for t in framed for w in t[1:]), Counter(p for t in framed for p in zip(t, t[1:]))
    n, v = sum(words.values()), len(words)
    of = lambda c: float(scoring.count_of(scoring.level(np.array([c])))[0])
    own = lambda w: (of(words[w]) + 0.1) / (n + 0.1 * (v + 1))
    want = [sum(math.log10(0.4 * min(of(pairs[a, b]) / of(words[a]), 1) + 0.6 * min(own(b), 1)) for a, b in zip(t, t[1:])) for t in framed]
    assert sum(c == 1 for c in pairs.values()) > len(pairs) / 2
    assert all(math.isclose(got[i], w, rel_tol=1e-9) for i, w in enumerate(want))


def test_packing(spark, docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = packing.pack(docs, vocabulary("word_bpe_49k.json"), bucket_rows=3).collect()
    want = sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in ROWS)
    assert sum(r["length"] for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    ids = np.array([*tokenizer.encode(ROWS[0][1], add_special_tokens=False).ids, 0], dtype="<u4")
    assert next(r for r in got if r["doc_id"] == 1)["ids_crc32"] == zlib.crc32(ids.tobytes())
    assert packing.pack(none, vocabulary("word_bpe_49k.json")).count() == 0


def test_bins_hold_every_piece():
    rng = np.random.default_rng(2)
    h = Counter(int(x) for x in rng.integers(1, 2049, 5000))
    bins = packing.plan_bins(dict(h), 2048)
    used = Counter()
    for many, lengths in bins:
        assert sum(lengths) <= 2048 and sum(3 * x > 2048 for x in lengths) <= 2
        for x in lengths:
            used[x] += many
    assert used == h and sum(m for m, _ in bins) <= 1.35 * sum(k * v for k, v in h.items()) / 2048


def test_encoder_equals_tokenizer():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    encoder, tokenizer = packing.WordEncoder(path, most_words=5), Tokenizer.from_file(path)
    for text in ["", "it's a.'s b!!!'re x", "naïve Straße…. İstanbul ſharp", "áb <|endoftext|> foo", "tab\tnl nb x", "ab≠c a̸", "don't.Stop,me'll 12ab 3.5'd"]:
        for chunk in _bytes.chunks(pa.array([text, "plain text"])):
            assert [list(r) for r in encoder.rows(chunk)] == [e.ids for e in tokenizer.encode_batch([text, "plain text"], add_special_tokens=False)]


def test_licenses(spark, docs, none):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", "hello"), (3, None, "x"), (4, "z.py", None), (5, "q/s.c", '// Licensed under the Apache License, Version 2.0 (the "License");\n// you may not use this file except in compliance with the License.\nint x;'), (6, "p/t.txt", "licensed drivers may apply to the office for a permit")]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string"), F.col("path")).collect()}
    assert [got[i]["license"] for i in range(1, 7)] == ["MIT", "MIT", None, None, "Apache-2.0", None] and got[2]["origin"] == "inherited" and got[2]["from_doc_id"] == 1
    assert licenses.scan(docs, F.col("source")).count() == 10 and licenses.scan(none, F.col("source")).count() == 0


MIT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""


def test_licences_in_headers_and_files(spark):
    """Notices broken over lines, heads of licence files, identifiers; near any depth, and no false ones."""
    apache = "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n"
    gpl = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n"
    deep = "/".join(f"d{i}" for i in range(90))
    rows = [(1, "m/LICENSE", MIT), (2, "a/LICENSE", apache + "body of terms " * 50), (3, "g/COPYING", gpl), (4, "s/x.py", "# SPDX-License-Identifier: MIT\nimport os\n"), (5, f"g/{deep}/y.py", "print(1)"), (6, "u/x.py", "# SPDX-License-Identifier: Foo-9.9\nimport os\n"), (7, "u/z.md", "we license photographs to the press\n" * 3), (8, "h/x.c", "int a;\n" * 400 + MIT), (9, "h/x.c", "int a;\n" * 400 + MIT)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string"), F.col("path")).collect()}
    assert [got[i]["license"] for i in range(1, 10)] == ["MIT", "Apache-2.0", "GPL-3.0", "MIT", "GPL-3.0", None, None, "MIT", "MIT"]
    assert got[5]["origin"] == "inherited" and got[5]["from_doc_id"] == 3 and len(got) == 9


def test_language(spark, docs, none):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.pmod(language.crc_of(F.col("doc_id")), F.lit(4)) == 2
    model = language.train(rows.filter(~held))
    right = rows.filter(held).join(language.predict(rows, model), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (4, "¿?…")], "doc_id long, text string")
    assert [(r["lang_pred"], r["score"]) for r in language.predict(odd, model).collect()] == [("und", 0.0)] * 4
    mixed = spark.createDataFrame([(1, "the and that of in was for with " * 4 + "der und die das nicht ist von mit " * 4)], "doc_id long, text string")
    spans = language.predict(mixed, model, spans=True).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "de"]
    assert language.keep_identified(docs, model).columns == docs.columns and language.predict(none, model).count() == 0
    assert language.predict(odd, language.train(none)).filter("lang_pred <> 'und'").count() == 0


def test_pipeline_runs_whole(spark, tmp_path):
    """Every stage on what the one before kept, against plain Python: rejected, exact and near
    copies go, sources are mixed within their bounds, and every token of the mix is packed."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = [(-1, "12345 !!", "en", "web", 8), (-2, None, "en", "web", 0), (None, "Nameless text about nothing in particular", "en", "web", 40), (-3, "Nameless TEXT about nothing in particular", "en", "web", 40)]
    rows.unionByName(spark.createDataFrame(more, rows.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.columns == rows.columns
            kept.append([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    ids = {x[0] for x in kept[0]}
    assert -1 not in ids and -2 not in ids and len(kept[0]) >= 0.95 * rows.filter("text IS NOT NULL").count()
    best: dict[str, int] = {}
    for d, t, _ in kept[0]:
        best[low(t)] = max(best.get(low(t), -(10**9)), d if d is not None else -(10**9))
    assert sorted((d, low(t)) for d, t, _ in kept[1]) == sorted((d, t) for t, d in best.items())
    report = {r["doc_id"]: r["kept"] for r in minhash.near_duplicates(spark.read.parquet(str(tmp_path / "exact_dedup"))).collect()}
    assert sorted(x[0] for x in kept[2]) == sorted(d for d, k in report.items() if k)
    mixed, before = Counter(kept[3]), set(kept[2])
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert set(mixed) <= before and max(mixed.values()) <= 2
    assert abs(sum(size(t) * n for (_, t, _), n in mixed.items()) - 1.5 * sum(size(t) for _, t, _ in before)) <= max(size(t) for _, t, _ in before)
    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    assert docs.agg(F.sum("length")).first()[0] == sum(n * (len(tokenizer.encode(t, add_special_tokens=False).ids) + 1) for (_, t, _), n in mixed.items())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()



def test_dealt_members_meet_once(spark):
    from tidemark.llm._groups import dealt

    rows = [(b, b * 1000 + i, 0 if i < common else i % 7) for b, (size, common) in enumerate([(40, 36), (30, 0), (9, 5), (2, 1)]) for i in range(size)]
    got = dealt(spark.createDataFrame(rows, "bucket long, node long, root long"), ["bucket"], "root", "node", 4).collect()
    groups: dict[tuple, list] = {}
    for r in got:
        groups.setdefault((r["bucket"], r["low"], r["high"]), []).append(r)
    met = Counter(tuple(sorted((x["node"], y["node"]))) for (_, low, high), g in groups.items() for i, x in enumerate(g) for y in g[i + 1 :] if x["root"] != y["root"] and (low == high or x["side"] != y["side"]))
    want = {tuple(sorted((a[1], b[1]))) for i, a in enumerate(rows) for b in rows[i + 1 :] if a[0] == b[0] and a[2] != b[2]}
    assert set(met) == want and set(met.values()) == {1}
    assert sum(r["bucket"] == 0 for r in got) <= 36 + 4 * 10


def test_embeddings_recall(spark):
    """Against brute force, on clusters whose links lie all over the range from the threshold up."""
    rng = np.random.default_rng(8)
    centers = rng.standard_normal((60, 64))
    x = np.repeat(centers, 12, axis=0) + rng.uniform(0.1, 0.42, 720)[:, None] * rng.standard_normal((720, 64))
    x[5] *= 1e200  # squares overflow
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = ((unit @ unit.T) >= 0.9).sum(axis=1) - 1
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert want.sum() > 1500 and (found <= want).all() and found.sum() >= 0.95 * want.sum() and (found[5] > 0) == (want[5] > 0)


def test_near_duplicates_equal_brute_force(spark):
    """Every pair at the threshold or above is linked, by weighted Jaccard over all sets."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: _bytes.LOWER[np.frombuffer((r["text"] or "").encode(), dtype=np.uint8)].tobytes().decode() for r in docs.select("doc_id", "text").collect()}
    sets: dict[int, Counter] = {}
    for k, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets[k] = Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()
    n, df = len(sets), Counter(s for c in sets.values() for s in c)
    weighed = {k: {s: m * float(minhash.inverse_frequency(np.array([df[s]]), n, 0.85)[0]) for s, m in c.items()} for k, c in sets.items()}
    root = {k: k for k in sets}
    ids = sorted(sets)
    near = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = weighed[a], weighed[b]
            if x and y and not x.keys().isdisjoint(y):
                shared = sum(min(v, y[s]) for s, v in x.items() if s in y)
                if shared >= 0.8 * (sum(x.values()) + sum(y.values()) - shared):
                    near.append((a, b))
    for _ in range(10):
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()}
    assert len(near) > 5 and sum(got[k] != root[k] for k in ids) <= 0.02 * len(ids)
