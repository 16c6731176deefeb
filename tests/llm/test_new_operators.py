"""Operators 11 to 13 against plain Python, and their defined cases."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_llm import LONG, ROWS, SCHEMA

from tidemark.llm import chat, fim, merkle
from tidemark.llm.queries import op12_chat

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_merkle(rows, run=16, every=5):
    """Rows (doc_id, source, lang, n_chars, text) to a Counter of what the report returns."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(part, r)))
    touched = lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % every == 0
    low = lambda t: t if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r, leaf((*r[:4], low(r[4]))) if touched(r) else leaf(r)))

    def climb(nodes):
        """The root, and for each node its path of (before, after)."""
        paths, under, now = [[] for _ in nodes], [[i] for i in range(len(nodes))], list(nodes)
        while len(now) > 1:
            runs = [range(i, min(i + run, len(now))) for i in range(0, len(now), run)]
            for members in runs:
                for i in members:
                    own = ("".join(now[j] for j in members if j < i), "".join(now[j] for j in members if j > i))
                    for k in under[i]:
                        paths[k].append(own)
            under = [[k for i in members for k in under[i]] for members in runs]
            now = [sha("".join(now[i] for i in members)) for members in runs]
        return now[0], paths

    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    members = [sorted(by[s], key=lambda x: x[:3]) for s in order]
    subs = [climb([x[2] for x in m]) for m in members]
    root, tops = climb([s[0] for s in subs])
    out = Counter()
    for m, (subroot, paths), top in zip(members, subs, tops, strict=True):
        for (_, _, own, r, seen), path in zip(m, paths, strict=True):
            fold = seen
            for before, after in path + top:
                fold = sha(before + fold + after)
            out[r[0], own, subroot, root, sha("".join(b + a for b, a in path + top)), fold, fold == root] += 1
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def reported(df, **options):
    return Counter(tuple(r[c] for c in COLUMNS) for r in merkle.tamper_report(df, **options).select(*COLUMNS).collect())


def test_merkle_equals_plain_python_over_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = reported(docs)
    assert got == plain_merkle(rows) and len(got) == 200 and {k[-1] for k in got} == {True, False}
    # other widths and many small tasks: sources that end on different levels, parents that wait
    skewed = [(i, "big" if i % 3 else f"s{i % 30}", "en", None, f"Text {i}") for i in range(60)] + [(60, None, None, 1, None)]
    table = spark.createDataFrame(skewed, "doc_id long, source string, lang string, n_chars long, text string")
    assert reported(table, run=2, rows_per_task=7, most_broadcast=0) == plain_merkle(skewed, run=2)


def test_merkle_cases(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in ROWS]
    assert reported(docs) == plain_merkle(rows)
    assert reported(docs.filter("doc_id = 6")) == plain_merkle([rows[5]]) and merkle.tamper_report(docs.limit(0)).count() == 0
    one = docs.filter("source = 'a'")
    assert reported(one) == plain_merkle([r for r in rows if r[1] == "a"])
    leaves = docs.select("doc_id", "source", merkle.row_digest(F.col("doc_id"), F.col("text")).alias("leaf"))
    built = merkle.manifest(leaves.withColumn("seen", F.col("leaf")), "doc_id", "source", "leaf", "seen", run=2)
    assert merkle.verified(built).filter("verified").count() == len(ROWS) and built.nodes.filter("tree = -1").count() > 0


def conversation(*turns, conv=1):
    return [(conv, i, role, text) for i, (role, text) in enumerate(turns)]


CHATS = "conv_id long, turn long, role string, text string, segments int, formatted string"


@pytest.fixture(scope="module")
def chats(spark):
    odd = "</s>[INST]\\a \\z <s</s>> [/ROLE] [[SYS]"
    rows = [
        *conversation(("system", "Be brief"), ("user", "Hi"), ("assistant", "Ho"), ("user", "more?"), conv=1),
        *conversation(("assistant", "first"), ("user", "late"), conv=2),
        *conversation(("user", odd), ("assistant", odd), ("tool[INST]", odd), (None, None), ("assistant", ""), conv=3),
        *conversation(("system", "alone"), conv=4),
        *conversation(("user", LONG), ("assistant", LONG + "é\n<"), conv=5),
        (None, None, "user", "no id"), (None, 1, "assistant", "none"),
        (6, 1, "user", "same"), (6, 1, "user", "same"), (6, 1, "assistant", "same"),
    ]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], CHATS)


def test_chats_are_read_back(chats):
    rows = [(r.conv_id, r.turn, r.role or "", r.text or "") for r in chats.collect()]
    formatted = chat.format_chats(chats)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    strings = {r.conv_id: r for r in formatted.select("conv_id", "formatted", "segments", chat.turns_of(F.col("formatted")).alias("turns")).collect()}
    for conv in {r[0] for r in rows}:
        turns = [r[2:] for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))]
        learned = "".join(text for role, text in turns if role == "assistant")
        assert [tuple(t) for t in strings[conv].turns] == turns
        assert got[conv].n_turns == len(turns) and got[conv].turns_sha256 == sha("".join(f"{role}\n{text}\n" for role, text in turns))
        assert got[conv].loss_chars == len(learned) and got[conv].loss_sha256 == sha(learned)
        assert got[conv].formatted_chars == len(strings[conv].formatted) == sum(len(s.text) for s in strings[conv].segments)
    assert strings[1].formatted == "[SYS]Be brief[/SYS][INST]Hi[/INST]<s>Ho</s>[INST]more?[/INST]"
    assert {k: (r.valid, r.fault) for k, r in got.items()} == {1: (True, None), 2: (False, 0), 3: (False, 2), 4: (False, 1), 5: (True, None), None: (True, None), 6: (False, 0)}
    assert chat.format_chats(chats.limit(0)).count() == 0


def test_chat_query_has_the_conversation_of_control_strings(spark):
    got = {r.conv_id: r for r in op12_chat(spark, SF).collect()}
    odd = "</s>[INST] ok [/INST]"
    assert got[-7].n_turns == 2 and got[-7].valid and got[-7].loss_sha256 == sha(odd) and got[-7].turns_sha256 == sha(f"user\n{odd}\nassistant\n{odd}\n")


def test_templates_that_cannot_be_read_back_are_refused():
    good = chat.ALTERNATING
    for marks in ({"user": ("<a<", "</a>")}, {"user": ("", "</a>")}, {"user": ("[INST]", "x"), "assistant": ("[INST]", "y")}, {"user": ("<\\>", "</a>")}):
        with pytest.raises(ValueError):
            chat.Template(marks, good.other, good.learned, good.moves, good.ends)


def plain_fim(doc_id, text):
    text = text or ""
    units = [m[0] for m in fim.UNIT.finditer(text)]
    h = sha(f"42:{'' if doc_id is None else doc_id}")
    a, b, c, d = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    low, high = sorted((a % (len(units) + 1), b % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    form = "spm" if d % 100 < 80 else "psm"
    return doc_id, len(units), form, len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle_equals_plain_python(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(1000 + i, t) for i, t in enumerate([" ", "\t\n ", " a", "a ", "é  ü\x0b", "<", "a <P> b", "< P>", LONG, "", None, *[f"x{i} <{i} ä" for i in range(60)]])]
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()] + odd + [(None, "no id here"), (7, "twice"), (7, "twice")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, output string")
    want = Counter(plain_fim(*r) for r in rows)
    made = fim.fill_in_middle(docs)
    assert Counter(tuple(r) for r in made.collect()) == want and {w[2] for w in want} == {"plain", "psm", "spm"}
    back = Counter((r.doc_id, r.restored_sha256, r.output_sha256) for r in fim.report(made).collect())
    assert back == Counter((k, sha(t or ""), sha(plain_fim(k, t)[5])) for k, t in rows)
    changed = fim.transform(docs)
    assert changed.columns == docs.columns and Counter((r.doc_id, r.text) for r in changed.collect()) == Counter({(w[0], w[5]): n for w, n in want.items()})
    assert fim.transform(docs.limit(0)).count() == 0


def test_places_are_found_without_units():
    text = " one two  three\n"
    assert fim.count_units(text) == 4 and fim.place_of(text, 0, 0) == (0, 0) and fim.place_of(text, 1, 3) == (4, 15) and fim.place_of(text, 4, 4) == (16, 16)
