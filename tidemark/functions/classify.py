"""Job categories from ordered rules: a title match beats an industry match, then the first rule."""

from __future__ import annotations

from re import _parser as parser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Priority, category, words of titles, words of industries.
RULES: list[tuple[int, str, str | None, str | None]] = [
    (10, "Data & Analytics", r"data (analyst|analytics|engineer|scientist|architect|steward|manager|warehouse\w*)|analytics|business intelligence|bi (developer|analyst|engineer)|statistician|machine learning|ml engineer|ai engineer", None),
    (20, "Software & IT", r"software|developer|programmer|devops|sre|full[- ]?stack|front[- ]?end|back[- ]?end|web (developer|designer)|mobile (developer|app\w*)|qa engineer|tester|cyber ?security|network (engineer|administrator)|systems? (administrator|engineer|analyst)|it (support|officer|manager|technician|specialist)|ict|helpdesk|help desk|cloud|database administrator|dba|infrastructure|technical support", r"ict|it|computer|information technology|information and communications? technology|software|telecom\w*"),
    (30, "Sales & Marketing", r"sales|dealer|marketer|marketing|business development|brand|social media|digital marketing|merchandis\w*|key accounts?|account (manager|executive)|customer acquisition|promoter|telesales", r"sales|marketing|advertising|public relations"),
    (40, "Finance & Accounting", r"account(ant|ants|ing|s)?|finance|financial|audit\w*|tax|treasury|bookkeep\w*|payroll|credit (analyst|controller|officer)|cashier|budget\w*|actuar\w*", r"accounting|finance|banking|audit\w*|insurance|financial services"),
    (50, "Human Resources", r"human resources?|hr|recruit\w*|talent|people (and culture|partner)|learning and development|l&d|training officer", r"human resources?|hr|recruitment"),
    (60, "Engineering & Construction", r"engineer\w*|civil|mechanical|electrical|electrician|technician|surveyor|architect\w*|foreman|site (manager|supervisor|engineer)|construction|plumber|welder|mason|artisan|draughts\w*|structural", r"engineering|construction|building|architecture"),
    (70, "Health & Medical", r"nurse|nursing|doctor|clinical|clinician|medical|pharmac\w*|laborator\w*|physician|dentist|midwife|paramedic|radiograph\w*|nutritionist|veterinar\w*|health (officer|worker|records|coordinator)", r"medical|health\w*|pharmac\w*|nursing|healthcare"),
    (80, "Hospitality & Tourism", r"chef|cook|waiter|waitress|barista|bartender|hotel|hospitality|restaurant|kitchen|housekeep\w*|front office|receptionist|concierge|tour (guide|operator)|travel|safari|lodge|service crew|pizzaiolo|baker|catering", r"hospitality|hotel\w*|tourism|catering|travel|restaurant\w*"),
    (90, "Logistics & Supply Chain", r"driver|logistics|supply chain|warehouse\w*|procurement|stores?|fleet|transport\w*|shipping|clearing|forwarding|dispatch\w*|rider|delivery|courier|inventory|purchasing|distribution", r"logistics|transport\w*|supply chain|procurement|shipping|distribution"),
    (100, "Education & Training", r"teacher|lecturer|tutor|principal|headteacher|head teacher|school|academic|instructor|trainer|professor|librarian|education|curriculum", r"education|teaching|training|academic\w*"),
    (105, "Agriculture & Environment", r"agronom\w*|agricultur\w*|farm\w*|horticultur\w*|livestock|forest\w*|environment\w*|extension officer|crop|fisheries|agribusiness", r"agricultur\w*|agribusiness|environment\w*|farming|forestry"),
    (110, "NGO & Development", r"programme|program|project (officer|coordinator|manager|assistant)|monitoring|evaluation|m&e|humanitarian|protection|livelihoods?|grants?|advocacy|community (mobili[sz]er|development)|field officer|consultan\w*", r"ngo|non[- ]?profit|development|humanitarian|charity|social work\w*"),
    (115, "Legal & Compliance", r"legal|lawyer|advocate|paralegal|compliance|company secretary|counsel|risk", r"legal|law|compliance"),
    (120, "Admin & Support", r"admin\w*|secretary|receptionist|clerk|office (assistant|manager|administrator)|personal assistant|executive assistant|data entry|virtual assistant|customer (service|care|support|experience)|call cent(re|er)|front desk|assistant|support officer", r"administration|secretarial|customer service|clerical"),
]

OTHER = "Other"


def whole_words(pattern: str) -> str:
    return rf"(?iu)\b({pattern})\b"


def classify_category(title: Column, industry: Column, rules=None) -> Column:
    """One chain of literal patterns: all title patterns by priority, then all industry patterns."""
    ordered = sorted(RULES if rules is None else rules)
    chain = None
    for of, column in ((2, title), (3, industry)):
        for rule in ordered:
            if rule[of]:
                hit = column.rlike(whole_words(rule[of]))
                chain = F.when(hit, rule[1]) if chain is None else chain.when(hit, rule[1])
    return F.lit(OTHER) if chain is None else chain.otherwise(OTHER)


def rules_table(spark, rules=None) -> DataFrame:
    rows = [(p, c, t and whole_words(t), i and whole_words(i)) for p, c, t, i in (RULES if rules is None else rules)]
    return spark.createDataFrame(rows, "priority int, category string, title_regex string, industry_regex string")


# ---- rules as data ----

#: How many characters of a word that a pattern leaves open are its key.
OPEN_KEY = 3


def first_words(pattern: str) -> set[tuple[str, bool]]:
    """The words that a match can begin with, in lower case, and whether each is whole or goes on.
    An empty word stands for a beginning that is no literal."""

    def walk(items: list, word: str) -> set[tuple[str, bool]]:
        for at, (kind, value) in enumerate(items):
            rest = items[at + 1 :]
            if kind is parser.SUBPATTERN:
                return walk([*value[-1], *rest], word)
            if kind is parser.BRANCH:
                return {x for branch in value[1] for x in walk([*branch, *rest], word)}
            if kind is parser.MAX_REPEAT and value[1] == 1:
                return walk(rest, word) | walk([*value[2], *rest], word) if value[0] == 0 else walk([*value[2], *rest], word)
            if kind is parser.IN and word and all(k is parser.LITERAL and not _in_words(v) for k, v in value):
                return {(word, True)}
            if kind is parser.LITERAL and _in_words(value):
                word += chr(value).lower()
            elif kind is parser.LITERAL or kind is parser.AT and word:
                return {(word, bool(word))}
            elif kind is not parser.AT:
                break
        return {(word, False)}

    return walk(list(parser.parse(pattern)), "")


def _in_words(code: int) -> bool:
    return code < 128 and (chr(code).isalnum() or chr(code) == "_")


@F.pandas_udf(T.ArrayType(T.StringType()))
def rule_keys(patterns: pd.Series) -> pd.Series:
    """Under which keys a pattern is to be found: =word, ^beginning of a word, or * for any text."""
    key = lambda word, whole: f"={word}" if whole else f"^{word[:OPEN_KEY]}" if len(word) >= OPEN_KEY else "*"
    return patterns.map(lambda p: sorted({key(*x) for x in first_words(p)}), na_action="ignore")


def text_keys(text: Column) -> Column:
    """The keys of all rules that could match a text: each of its words, its beginning, and *."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.upper(text)), F.lit(r"\w+"), F.lit(0)))
    return F.concat(F.transform(words, lambda w: F.concat(F.lit("="), w)), F.array_distinct(F.transform(words, lambda w: F.concat(F.lit("^"), F.left(w, F.lit(OPEN_KEY))))), F.array(F.lit("*")))


def _matched(texts: DataFrame, rules: DataFrame, pattern: str) -> DataFrame:
    """(text, category): the first rule by priority, then name, whose pattern is in a text."""
    index = rules.filter(F.col(pattern).isNotNull()).select("priority", "category", F.col(pattern).alias("pattern"), F.explode(rule_keys(pattern)).alias("key"))
    asked = texts.select("text", F.explode(text_keys(F.col("text"))).alias("key"))
    likely = asked.join(index, "key").select("text", "priority", "category", "pattern").distinct()
    return likely.filter(F.regexp_like("text", "pattern")).groupBy("text").agg(F.min(F.struct("priority", "category")).alias("best")).select("text", "best.category")


def classify_by_table(df: DataFrame, title: str, industry: str, rules: DataFrame) -> DataFrame:
    """``df`` with ``category``, by rules that are edited as data: a table (priority, category,
    title_regex, industry_regex) of any size.

    Rules are indexed under the words that their matches begin with, and the distinct texts look
    them up under their own words, so that a pattern is tried on texts only that have such a word.
    """
    found = df
    for column, pattern, name in ((title, "title_regex", "by_title"), (industry, "industry_regex", "by_industry")):
        texts = df.select(F.col(column).alias("text")).filter("text IS NOT NULL").distinct()
        own = _matched(texts, rules, pattern).select(F.col("text").alias(f"{name}_text"), F.col("category").alias(name))
        found = found.join(own, F.col(column) == F.col(f"{name}_text"), "left").drop(f"{name}_text")
    return found.withColumn("category", F.coalesce("by_title", "by_industry", F.lit(OTHER))).drop("by_title", "by_industry")
