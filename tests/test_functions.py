"""Column functions against values worked out by hand."""

import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from tidemark.functions import classify, dates, geo, salary, skills, stats, text


def values(spark, inputs, make, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_norm_text_folds_like_nfkd(spark):
    inputs = ["Café  Olé!", "ﬁne ½ ™ naïve", None, "", "Straße Ø", "Ａbc…"]
    import re

    def plain(s):
        s = unicodedata.normalize("NFKD", s or "").encode("ascii", "ignore").decode()
        return re.sub(r"[^a-z0-9]+", " ", s.lower()).strip()

    assert values(spark, inputs, text.norm_text) == [plain(x) for x in inputs]


def test_html_to_text(spark):
    got = values(spark, ["<p>a&amp;b<script>x</script><b>c</b></p>", "&lt;p&gt;d&lt;/p&gt;", None], text.html_to_text)
    assert got == ["a&b c", "d", ""]


def test_contacts_are_masked(spark):
    got = values(spark, ["mail a.b@c.co.ke or +254 712 345 678", "id 07123456789"], text.redact_contacts)
    assert got == ["mail [email] or [phone]", "id 07123456789"]


def test_dates(spark):
    assert [str(d) for d in values(spark, ["on 2026-02-28T10:00", "2026-02-31", "no", None], text.parse_date)] == ["2026-02-28", "None", "None", "None"]
    assert values(spark, ["Posted: Sep 22, 2026", "sept 3 2025", "x"], text.parse_month_day)[0] == "2026-09-22"
    keys = values(spark, ["2026-09-24", "1999-12-31", "2041-01-01", None], lambda c: dates.date_key(c.cast("date")))
    assert keys == [20260924, -1, -1, -1]
    noon = values(spark, ["2026-01-05"], lambda c: F.date_format(dates.local_noon(c.cast("date")), "yyyy-MM-dd HH:mm"))
    assert noon == ["2026-01-05 09:00"]
    assert [str(d) for d in values(spark, ["2026-01-07"], lambda c: dates.week_start(c.cast("date")))] == ["2026-01-05"]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("URGENT: ACCOUNTANT - NAIROBI", "Accountant"),
        ("data analyst (Urgent hiring)", "Data Analyst"),
        ("Sales Manager, Nairobi, Kenya", "Sales Manager"),
        ("Head of IT in Mombasa", "Head of IT"),
        ("it support officer", "IT Support Officer"),
        ("Front-end Developer at Acme", "Front-end Developer at Acme"),
        (None, ""),
    ],
)
def test_titles(spark, raw, clean):
    assert values(spark, [raw], text.clean_title) == [clean]


def test_smart_title(spark):
    assert values(spark, ["HEAD OF HR AND M&E", "THE FRONT-END OF IT"], text.smart_title) == ["Head of HR and M&E", "The Front-End of IT"]


def test_seniority(spark):
    got = values(spark, ["Chief Executive Officer", "Sales Manager", "Senior Nurse", "Mid-Level Developer", "Graduate Trainee", "Intern", "Cook", None], text.seniority)
    assert got == ["director", "manager", "senior", "mid", "junior", "intern", "unspecified", "unspecified"]


def test_companies(spark):
    assert values(spark, ["Acme  Ltd.", "Confidential Employer", "Our Client", "", None], text.company_norm) == ["acme", None, None, None, None]
    assert values(spark, ["  A &amp;  B ", ""], text.clean_company) == ["A & B", None]


def test_locations(spark):
    got = values(spark, ["Westlands, Nairobi", "Remote - Kisumu City", "Murang'a County", "Berlin", None, "Thika / Nakuru", "Homa Bay"], geo.map_location)
    assert [(r["county"], r["county_code"], r["is_remote"]) for r in got] == [
        ("Nairobi", 47, False), ("Kisumu", 42, True), ("Murang'a", 21, False), (None, None, False), (None, None, False), ("Kiambu", 22, False), ("Homa Bay", 43, False),
    ]
    assert len(geo.county_names()) == 47
    assert values(spark, ["Nairobi, Kenya", "Nairobi office", ""], geo.is_location_only) == [True, False, False]


def pay(spark, *inputs):
    return values(spark, list(inputs), salary.from_text)


def test_salaries_in_text(spark):
    a, b, c, d, e, f = pay(spark, "KES 80,000 - 120,000 per month", "up to KES 100,000", "Ksh 50 - 80k monthly", "USD 2,000 to 3,000 per month", "KES 1,200,000 per annum", "KES 100")
    assert (a["min"], a["max"], a["period"], a["min_monthly_kes"]) == (80000, 120000, "month", 80000)
    assert b is None and f is None
    assert (c["min"], c["max"]) == (50000, 80000)
    assert (d["currency"], d["min_monthly_kes"]) == ("USD", None)
    assert (e["period"], e["min_monthly_kes"]) == ("year", 100000)


def test_salaries_structured(spark):
    df = spark.createDataFrame([("", "90000", "60000", None, "MONTH"), (None, None, None, "700000", "YEAR"), ("usd", None, "10", None, ""), ("KES", None, None, None, "")], "c string, l string, h string, s string, u string")
    got = [r[0] for r in df.select(salary.from_structured(*map(F.col, "clhsu"))).collect()]
    assert (got[0]["currency"], got[0]["min"], got[0]["max"]) == ("KES", 60000, 90000)
    assert round(got[1]["min_monthly_kes"]) == 58333
    assert (got[2]["min"], got[2]["max"], got[2]["min_monthly_kes"]) == (10, 10, None)
    assert got[3] is None


SENTENCES = [
    "Python, SQL-Server and Power-BI; C++ or C#.", "excel in service and spark joy", "Excel and Spark needed", "We use node.js, asp.net and ci/cd", "Javascript. No java!", "R programming, sap s/4hana",
    "visit python.org or go.python", "xpython python3 sql_server t-sql", None, "", "SAS, Swift, Flask, Sage 300 and react.js",
]


def test_skills_by_tokens_equal_skills_by_regex(spark):
    by_token, by_regex = values(spark, SENTENCES, skills.extract_skills), values(spark, SENTENCES, skills.extract_skills_by_regex)
    assert by_token == by_regex
    names = [{s["skill"] for s in row} for row in by_token]
    assert {"Python", "SQL", "SQL Server", "Power BI", "C++", "C#"} == names[0]
    assert names[1] == set() and names[2] == {"Excel", "Spark"}
    assert {"Node.js", ".NET", "CI/CD"} <= names[3] and "Java" in names[4]
    assert names[8] == set()


def test_term_join_equals_extraction(spark):
    terms = spark.createDataFrame([("python", "Python"), ("sql", "SQL")], "alias string, skill string")
    docs = spark.createDataFrame([(1, "Python. sql!"), (2, "x.python sqlite"), (3, None)], "id int, t string")
    assert sorted(map(tuple, skills.match_terms(docs, "id", "t", terms).collect())) == [(1, "Python"), (1, "SQL")]


CATEGORIES = [
    ("Data Analyst", None, "Data & Analytics"), ("Software Developer", "Banking", "Software & IT"), ("Account Manager", None, "Sales & Marketing"), ("Accountant", None, "Finance & Accounting"),
    ("HR Officer", None, "Human Resources"), ("Civil Engineer", None, "Engineering & Construction"), ("Nurse", None, "Health & Medical"), ("Chef", None, "Hospitality & Tourism"), ("Driver", None, "Logistics & Supply Chain"),
    ("Teacher", None, "Education & Training"), ("Agronomist", None, "Agriculture & Environment"), ("Field Officer", None, "NGO & Development"), ("Legal Counsel", None, "Legal & Compliance"), ("Office Assistant", None, "Admin & Support"),
    ("Widget Polisher", "Healthcare", "Health & Medical"), ("Widget Polisher", None, "Other"), (None, "ICT", "Software & IT"), (None, None, "Other"),
]


def test_categories(spark):
    df = spark.createDataFrame([(i, t, f) for i, (t, f, _) in enumerate(CATEGORIES)], "k int, t string, i string")
    by_chain = {r[0]: r[1] for r in df.select("k", classify.classify_category(F.col("t"), F.col("i"))).collect()}
    by_table = {r.k: r.category for r in classify.classify_by_table(df, "t", "i", classify.rules_table(spark)).collect()}
    assert by_chain == by_table == {i: c for i, (_, _, c) in enumerate(CATEGORIES)}


def test_first_words_of_patterns():
    words = lambda p: classify.first_words(classify.whole_words(p))
    assert words("data (analyst|engineer)|BI") == {("data", True), ("bi", True)}
    assert words(r"warehouse\w*|accounts?|full[- ]?stack") == {("warehouse", False), ("account", True), ("accounts", True), ("full", True), ("fullstack", True)}
    assert words("(senior|lead) cook|l&d|[ab]x|x+") == {("senior", True), ("lead", True), ("l", True), ("", False)}


def test_rules_as_data_equal_trying_every_pattern(spark):
    """Rules that begin with literals, parts of words, choices and nothing literal at all."""
    patterns = ["cooks?", r"bak\w*", "(head|sous)[- ]chef", "[xy]+z", r"\w*smith", "r&d", "café", "the (very )?end", "a"]
    rules = [(100 - i, f"c{i % 4}", classify.whole_words(p), classify.whole_words(p) if i % 2 else None) for i, p in enumerate(patterns)]
    words = ["cook", "Cooks", "bakery", "HEAD-CHEF", "souschef", "sous chef", "xyz", "locksmith", "R&D", "Café", "the end", "the very end", "a", "and", "cookshop", "bak", "érd", ""]
    rows = [(i, f"{words[i % len(words)]} {words[i * 7 % 11]}", words[i * 5 % len(words)] or None) for i in range(90)] + [(90, None, None)]
    df, table = spark.createDataFrame(rows, "k int, t string, i string"), spark.createDataFrame(rules, "priority int, category string, title_regex string, industry_regex string")
    got = {r.k: r.category for r in classify.classify_by_table(df, "t", "i", table).collect()}
    pairs = df.crossJoin(F.broadcast(table))  # a fixture's rows by a fixture's rules
    hit = lambda text, pattern: F.min(F.when(F.regexp_like(text, pattern), F.struct("priority", "category")))["category"]
    want = {r.k: r.category for r in pairs.groupBy("k").agg(F.coalesce(hit("t", "title_regex"), hit("i", "industry_regex"), F.lit("Other")).alias("category")).collect()}
    assert got == want and len(set(got.values())) == 5


def test_wilson(spark):
    df = spark.createDataFrame([(5, 10), (0, 10), (1, 0)], "k int, n int")
    low, high, none = df.select(stats.wilson_low(F.col("k"), F.col("n")), stats.wilson_high(F.col("k"), F.col("n"))).collect()
    assert [round(x, 4) for x in low] == [0.2366, 0.7634]
    assert low[0] < 0.5 < low[1] and [round(x, 4) for x in high] == [0.0, 0.2775] and tuple(none) == (None, None)


def test_survival_textbook_case(spark):
    df = spark.createDataFrame([("a", [1, 2, 2, 3, 4, 5], [True, True, False, True, False, True])], "g string, d array<int>, e array<boolean>")
    rows = stats.km_arrays(df, ["g"], "d", "e").orderBy("t").collect()
    assert [(r["t"], r["at_risk"], r["n_events"]) for r in rows] == [(1, 6, 1), (2, 5, 1), (3, 3, 1), (4, 2, 0), (5, 1, 1)]
    for got, want in zip([r["survival"] for r in rows], [5 / 6, 2 / 3, 4 / 9, 4 / 9, 0], strict=True):
        assert math.isclose(got, want, abs_tol=1e-6)
