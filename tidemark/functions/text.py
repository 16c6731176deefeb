"""Text cleaning as Column expressions; HTML alone needs a parser and so a pandas function."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import geo

#: Patterns of addresses and numbers that are masked.
EMAIL = r"[\w.+-]+@[\w-]+\.[\w.-]+"
PHONE = r"(?<!\d)(?:\+?254|0)[\s-]?[17]\d{2}[\s-]?\d{3}[\s-]?\d{3}(?!\d)"

#: What is stripped from job titles, and how words are cased.
TITLE_PREFIX = r"(?iu)^\s*(?:urgent(?:ly)?(?:\s+(?:required|hiring))?|hiring|vacancy|job(?:\s+vacancy)?|we are hiring|wanted)\s*[:\-–—]\s*"
TITLE_BRACKETS = r"(?iu)[\(\[\{][^)\]}]*\b(?:urgent|hiring|immediate|apply now|vacanc(?:y|ies)|new|multiple positions?)\b[^)\]}]*[\)\]\}]"
TITLE_PLACE = r"(?iu)(?:\s*[-–—|,@]\s*|\s+(?:in|at)\s+)([A-Za-z' .]+)$"
ACRONYMS = ["it", "ict", "hr", "qa", "qc", "erp", "bi", "sql", "api", "ceo", "cfo", "coo", "cto", "ui", "ux", "sap", "crm", "seo", "pr", "ngo", "gis", "hse", "sme", "aws", "kra", "m&e"]
SMALL_WORDS = ["and", "or", "of", "the", "in", "for", "to", "a", "an", "at", "on", "&"]

#: Levels of seniority in order of precedence, and the words that tell them.
LEVELS = [
    ("director", r"\b(director|vp|vice president|ceo|cfo|coo|cto|cio|chief (?:executive|financial|operating|technology|information|marketing|people|human resources?) officer)\b"),
    ("manager", r"\b(manager|head of|superintendent)\b"),
    ("senior", r"\b(senior|sr|lead|principal|chief|team leader)\b"),
    ("mid", r"\b(mid level|mid|intermediate)\b"),
    ("junior", r"\b(junior|jr|entry level|graduate)\b"),
    ("intern", r"\b(intern|interns|internship|attachment|attache|trainee|apprentice)\b"),
]

#: Legal forms, and names that hide an employer.
LEGAL_FORMS = r"(?iu)\b(?:limited|ltd|plc|inc|llc|llp|company|corp|corporation|gmbh)\b\.?"
HIDDEN_EMPLOYERS = ["confidential", "undisclosed", "anonymous", "our client", "client", "a leading company"]

_SPACE = r"(?U)\s+"


@cache
def _folding() -> tuple[str, str, list[tuple[str, str]]]:
    """Letters that decompose to one ASCII character, what they become, and those that become several."""
    one, to, several = [], [], []
    for point in [*range(0x80, 0x2200), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]:
        char = chr(point)
        plain = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one.append(char)
            to.append(plain)
        elif len(plain) > 1 and (point < 0x180 or 0x2020 < point < 0x2160 or point >= 0xFB00):
            several.append((char, plain))
    return "".join(one), "".join(to), several


def fold_ascii(text: Column) -> Column:
    """Accents off, other characters outside ASCII dropped. ASCII texts pass unchanged."""
    one, to, several = _folding()
    wide = text
    for char, plain in several:
        wide = F.replace(wide, F.lit(char), F.lit(plain))
    wide = F.regexp_replace(F.translate(wide, one, to), r"[^\x00-\x7F]", "")
    return F.when(F.length(text) == F.octet_length(text), text).otherwise(wide)


def norm_text(text: Column) -> Column:
    """Lower-case ASCII words with single spaces; null becomes ''."""
    return F.trim(F.regexp_replace(F.lower(fold_ascii(F.coalesce(text, F.lit("")))), r"[^a-z0-9]+", " "))


def redact_contacts(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, EMAIL, "[email]"), PHONE, "[phone]")


def parse_date(text: Column) -> Column:
    """The first yyyy-mm-dd anywhere; null if it is no day of the calendar."""
    return F.try_to_date(F.nullif(F.regexp_extract(text, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")), "yyyy-MM-dd")


def parse_month_day(text: Column) -> Column:
    """ISO text of a day such as 'Sep 22, 2026', null if there is none."""
    part = lambda k: F.regexp_extract(text, r"([A-Za-z]{3,9})\.?\s+(\d{1,2}),?\s+(\d{4})", k)
    day = F.concat_ws(" ", F.initcap(F.left(part(1), F.lit(3))), part(2), part(3))
    return F.when(part(1) != "", F.date_format(F.try_to_date(day, "MMM d yyyy"), "yyyy-MM-dd"))


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _SPACE, " "))


def smart_title(text: Column) -> Column:
    """Title case word by word: acronyms up, small words down but for the first, parts of
    hyphenated words each capitalised."""
    words = F.filter(F.split(text, " "), lambda w: w != "")
    cap = lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, 2, 1 << 20)))

    def cased(word: Column, i: Column) -> Column:
        low = F.lower(word)
        return F.when(low.isin(ACRONYMS), F.upper(low)).when((i > 0) & low.isin(SMALL_WORDS), low).otherwise(F.array_join(F.transform(F.split(word, "-"), cap), "-"))

    return F.array_join(F.transform(words, cased), " ")


def fix_case(text: Column) -> Column:
    """Re-case what is shouted (60 % capitals or more) or has no capital at all."""
    letters = F.length(F.regexp_replace(text, r"\P{L}", ""))
    capitals = F.length(F.regexp_replace(text, r"\P{Lu}", ""))
    return F.when((letters > 0) & ((capitals * 10 >= letters * 6) | (capitals == 0)), smart_title(text)).otherwise(text)


def unescape(text: Column) -> Column:
    """The entities that titles and names hold; markup goes through html_to_text."""
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#039;", "'"), ("&apos;", "'"), ("&ndash;", "–"), ("&mdash;", "—"), ("&#8211;", "–"), ("&#8217;", "’"), ("&rsquo;", "’"), ("&eacute;", "é"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def tidy_title(raw: Column) -> Column:
    """Noise words and bracketed noise off; null gives ''."""
    t = collapse(unescape(F.coalesce(raw, F.lit(""))))
    return F.regexp_replace(F.regexp_replace(t, TITLE_PREFIX, ""), TITLE_BRACKETS, " ")


def placeless_title(tidy: Column) -> Column:
    """Up to three trailing places off."""
    bound = F.struct(tidy.alias("t"), F.lit(True).alias("go"))

    def strip(state: Column, _: Column) -> Column:
        place = F.regexp_extract(state["t"], TITLE_PLACE, 1)
        cut = state["go"] & (place != "") & geo.is_location_only(place)
        return F.struct(F.when(cut, F.regexp_replace(state["t"], TITLE_PLACE, "")).otherwise(state["t"]).alias("t"), cut.alias("go"))

    # most titles end in no place: those are not taken through the steps
    t = F.when(tidy.rlike(TITLE_PLACE), F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), bound, strip)["t"]).otherwise(tidy)
    return F.regexp_replace(collapse(t), r"^[ \-–—|:,@]+|[ \-–—|:,@]+$", "")


def clean_title(raw: Column) -> Column:
    """Noise words, bracketed noise and up to three trailing places off; case repaired; null gives ''."""
    return fix_case(placeless_title(tidy_title(raw)))


def seniority(title: Column) -> Column:
    words = norm_text(title)
    found = F.when(words.rlike(LEVELS[0][1]), LEVELS[0][0])
    for level, pattern in LEVELS[1:]:
        found = found.when(words.rlike(pattern), level)
    return found.otherwise("unspecified")


def clean_company(name: Column) -> Column:
    return F.nullif(collapse(unescape(name)), F.lit(""))


def without_legal_forms(name: Column) -> Column:
    return F.regexp_replace(F.coalesce(name, F.lit("")), LEGAL_FORMS, " ")


def company_norm(name: Column) -> Column:
    """Comparable name; null where the employer is not named."""
    return named_employer(norm_text(without_legal_forms(name)))


def named_employer(n: Column) -> Column:
    """A normalised name; null where it hides the employer."""
    return F.when((n == "") | n.isin(HIDDEN_EMPLOYERS) | n.startswith("confidential"), None).otherwise(n)


class TextParts(HTMLParser):
    """Collects the text of a page outside of scripts, styles and comments."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def plain_text(markup: str | None) -> str:
    if not markup:
        return ""
    parser = TextParts()
    parser.feed(html.unescape(markup))
    parser.close()
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", " ".join(parser.parts))).strip()


@F.pandas_udf(T.StringType())
def html_to_text(markup: pd.Series) -> pd.Series:
    """Text of HTML: entities resolved, tags to spaces, white space collapsed; null gives ''."""
    return markup.map(plain_text, na_action=None)
