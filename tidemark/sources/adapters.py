"""Projections of each source's payload onto the common columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.raw_layer import text_at

COMMON = ["url", "title", "company", "location_text", "remote_hint", "date_posted", "valid_through", "employment_type", "industry", "description_html", "skills_text", "base_currency", "base_low", "base_high", "base_single", "base_unit", "salary_text"]

#: Parts of an address, of a salary and its amounts, and words of currencies in a salary text.
ADDRESS_PARTS = ["streetAddress", "addressLocality", "addressRegion"]
PAY, AMOUNTS = ["currency", "value"], ["minValue", "maxValue", "value", "unitText"]
KES_WORDS, USD_WORDS = r"\b(kes|ksh|kshs)\b", r"\busd\b|us\$|\$"


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def is_kind(v: Column, kind: str) -> Column:
    return _kind(v).startswith(kind)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def opened(v: Column, *fields: str) -> Column:
    """Fields of an object as variants, taken in one pass; null unless it is an object."""
    return F.try_variant_get(v, "$", f"struct<{', '.join(f'`{f}`: variant' for f in fields)}>")


def plain(v: Column) -> Column:
    """Text of a scalar; null for objects, arrays and empty text."""
    return F.when(~_kind(v).rlike("^(OBJECT|ARRAY)"), text_at(v, "$"))


def within(v: Column, path: str) -> Column:
    """Text of a scalar at a path of a variant."""
    return let(F.try_variant_get(v, path, "variant"), plain)


def joined(v: Column) -> Column:
    """A list's items with commas between, or a scalar's text."""
    return F.coalesce(F.nullif(F.array_join(F.try_variant_get(v, "$", "array<string>"), ", "), F.lit("")), plain(v))


def names(v: Column) -> Column:
    """The names of a list of objects."""
    items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))
    return F.filter(F.transform(items, lambda x: within(x, "$.name")), lambda n: n.isNotNull())


def as_list(v: Column) -> Column:
    return F.when(is_kind(v, "ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(v.isNotNull(), F.array(v))


def _places(location: Column) -> Column:
    """Parts of a location: a text, an object with an address or its parts, or a list of those."""
    none = F.array().cast("array<string>")

    def parts(inner: Column) -> Column:
        whole = F.nullif(F.try_variant_get(inner, "$", "string"), F.lit(""))
        fields = let(opened(inner, *ADDRESS_PARTS), lambda a: F.when(a.isNotNull(), F.array_compact(F.array(*[plain(a[f]) for f in ADDRESS_PARTS]))))
        return F.coalesce(fields, F.when(is_kind(inner, "STRING") & whole.isNotNull(), F.array(whole)), none)

    return F.coalesce(F.flatten(F.transform(as_list(location), lambda loc: let(F.coalesce(F.try_variant_get(loc, "$.address", "variant"), loc), parts))), none)


def place_in_headline(headline: Column, title: Column) -> Column:
    """What follows '<title> in ' in a page's headline."""
    prefix = F.concat(title, F.lit(" in "))
    h = F.trim(headline)
    return F.when(F.startswith(F.lower(h), F.lower(prefix)), F.nullif(F.trim(F.substr(h, F.length(prefix) + 1)), F.lit("")))


def currency_in(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.rlike(KES_WORDS), "KES").when(low.rlike(USD_WORDS), "USD")


class Fields:
    """An object of the payload, opened into columns of the rows beside it: the fields in ``texts`` as
    texts, those in ``named`` as lists of the names of objects, those in ``others`` as variants.

    The text of an object or a list is JSON. So a text that begins like one is looked at again: then all
    fields are opened once more as variants, which tell their kind. Few rows need that."""

    def __init__(self, column: str, paths: list[str], texts: list[str], named: list[str] = (), others: list[str] = ()):
        self.column, self.paths, self.texts, self.named, self.others = column, paths, texts, named, others

    def _open(self, payload: Column, types: dict[str, str]) -> Column:
        shape = f"struct<{', '.join(f'`{f}`: {t}' for f, t in types.items())}>"
        return F.coalesce(*[F.try_variant_get(payload, path, shape) for path in self.paths])

    def opened(self, payload: Column) -> Column:
        """Null unless there is an object at one of the paths; the first such counts."""
        types = dict.fromkeys(self.texts, "string") | dict.fromkeys(self.named, "array<struct<name: string>>") | dict.fromkeys(self.others, "variant")
        return self._open(payload, types).alias(self.column)

    def reopened(self, payload: Column) -> Column:
        """All fields as variants where a text may be that of an object or a list, else null."""
        of = F.col(self.column)
        begun = F.concat_ws("\0", *[F.left(of[f], F.lit(1)) for f in self.texts], *[of[f]["name"] for f in self.named])
        return F.when(begun.rlike(r"(?:^|\x00)[\[{]"), self._open(payload, dict.fromkeys([*self.texts, *self.named], "variant"))).alias(f"{self.column}_again")

    def text(self, field: str) -> Column:
        again = F.col(f"{self.column}_again")
        return F.when(again.isNull(), F.nullif(F.trim(F.col(self.column)[field]), F.lit(""))).otherwise(plain(again[field]))

    def names(self, field: str) -> Column:
        """The names of a list of objects, null for one without; null unless it is a list."""
        again = F.col(f"{self.column}_again")
        return F.when(again.isNull(), F.transform(F.col(self.column)[field]["name"], lambda n: F.nullif(F.trim(n), F.lit("")))).otherwise(names(again[field]))

    def listed(self, field: str) -> Column:
        return F.nullif(F.array_join(self.names(field), ", "), F.lit(""))

    def other(self, field: str) -> Column:
        return F.col(self.column)[field]


POSTING = Fields(
    "__posting", ["$.job_posting", "$"], ["url", "title", "jobLocationType", "datePosted", "validThrough", "description", "salaryText"],
    others=["hiringOrganization", "jobLocation", "employmentType", "industry", "occupationalCategory", "skills", "baseSalary"],
)
PAGE = Fields("__page", ["$"], ["url"], others=["page_meta"])
RELIEFWEB_PAGE = Fields("__reliefweb_page", ["$"], ["url"])
RELIEFWEB = Fields("__reliefweb", ["$.job"], ["url", "title", "body-html"], ["source", "city", "country", "type", "career_categories"], ["date"])
_JSEARCH = [
    "job_title", "employer_name", "job_apply_link", "job_google_link", "job_location", "job_city", "job_country", "job_is_remote", "job_posted_at_datetime_utc", "job_offer_expiration_datetime_utc", "job_employment_type",
    "industry", "job_function", "job_description", "job_salary_currency", "job_salary_string", "job_min_salary", "job_max_salary", "job_salary_period",
]
JSEARCH, JSEARCH_SEEN = Fields("__jsearch", ["$.job"], _JSEARCH, others=["required_technologies"]), Fields("__jsearch_seen", ["$.observed"], _JSEARCH)
JOOBLE = Fields("__jooble", ["$.job"], ["link", "title", "company", "location", "updated", "type", "snippet", "salary"])
REMOTIVE = Fields("__remotive", ["$.job"], ["url", "title", "company_name", "candidate_required_location", "publication_date", "job_type", "category", "description", "salary"], others=["tags"])


def _employer(org: Column) -> Column:
    """The name of an organisation, or of the first of a list."""
    return F.when(is_kind(org, "OBJECT"), within(org, "$.name")).otherwise(plain(org))


def _first(v: Column) -> Column:
    return F.when(is_kind(v, "ARRAY"), F.try_variant_get(v, "$[0]", "variant")).otherwise(v)


def schema_org() -> dict[str, Column]:
    """schema.org job postings, on their own or under job_posting beside the page's data."""
    of, other, title = POSTING.text, POSTING.other, POSTING.text("title")
    place = other("jobLocation")
    listed = F.when(is_kind(place, "STRING"), F.nullif(F.try_variant_get(place, "$", "string"), F.lit(""))).otherwise(F.nullif(F.array_join(_places(place), ", "), F.lit("")))
    named = text_at(PAGE.other("page_meta"), "$.og_title")
    headline = F.when(named.isNotNull(), let(title, lambda t: place_in_headline(named, t)))
    pay, amounts = opened(other("baseSalary"), *PAY), opened(F.try_variant_get(other("baseSalary"), "$.value", "variant"), *AMOUNTS)
    return dict(
        url=F.coalesce(PAGE.text("url"), of("url")),
        title=title,
        company=_employer(_first(other("hiringOrganization"))),
        location_text=F.array_join(F.array_distinct(F.array_compact(F.array(headline, listed))), ", "),
        remote_hint=F.coalesce(F.upper(of("jobLocationType")) == "TELECOMMUTE", F.lit(False)),
        date_posted=of("datePosted"),
        valid_through=of("validThrough"),
        employment_type=joined(other("employmentType")),
        industry=F.coalesce(joined(other("industry")), joined(other("occupationalCategory"))),
        description_html=of("description"),
        skills_text=F.coalesce(joined(other("skills")), F.lit("")),
        base_currency=plain(pay["currency"]),
        base_low=plain(amounts["minValue"]),
        base_high=plain(amounts["maxValue"]),
        base_single=F.when(amounts.isNotNull(), plain(amounts["value"])).otherwise(plain(pay["value"])),
        base_unit=plain(amounts["unitText"]),
        salary_text=of("salaryText"),
    )


def reliefweb() -> dict[str, Column]:
    of, listed = RELIEFWEB.text, RELIEFWEB.listed
    return dict(
        url=F.coalesce(RELIEFWEB_PAGE.text("url"), of("url")),
        title=of("title"),
        company=F.get(F.array_compact(RELIEFWEB.names("source")), F.lit(0)),
        location_text=F.coalesce(listed("city"), listed("country"), F.lit("")),
        date_posted=within(RELIEFWEB.other("date"), "$.created"),
        valid_through=within(RELIEFWEB.other("date"), "$.closing"),
        employment_type=listed("type"),
        industry=listed("career_categories"),
        description_html=of("body-html"),
    )


def jsearch() -> dict[str, Column]:
    """Stable and observed halves put together, the stable one first. No currency, no salary."""
    of = lambda name: F.coalesce(JSEARCH.text(name), JSEARCH_SEEN.text(name))
    low, high = of("job_min_salary"), of("job_max_salary")
    money = F.when(low.isNotNull() | high.isNotNull(), F.coalesce(of("job_salary_currency"), currency_in(of("job_salary_string"))))
    return dict(
        url=F.coalesce(of("job_apply_link"), of("job_google_link")),
        title=of("job_title"),
        company=of("employer_name"),
        location_text=F.coalesce(of("job_location"), F.concat_ws(", ", of("job_city"), of("job_country"))),
        remote_hint=F.coalesce(F.lower(of("job_is_remote")) == "true", F.lit(False)),
        date_posted=of("job_posted_at_datetime_utc"),
        valid_through=of("job_offer_expiration_datetime_utc"),
        employment_type=of("job_employment_type"),
        industry=F.coalesce(of("industry"), of("job_function")),
        description_html=of("job_description"),
        skills_text=F.coalesce(joined(JSEARCH.other("required_technologies")), F.lit("")),
        base_currency=money,
        base_low=F.when(money.isNotNull(), low),
        base_high=F.when(money.isNotNull(), high),
        base_unit=F.when(money.isNotNull(), F.upper(of("job_salary_period"))),
    )


def jooble() -> dict[str, Column]:
    of = JOOBLE.text
    return dict(url=of("link"), title=of("title"), company=of("company"), location_text=of("location"), date_posted=of("updated"), employment_type=of("type"), description_html=of("snippet"), salary_text=of("salary"))


def remotive() -> dict[str, Column]:
    of = REMOTIVE.text
    return dict(
        url=of("url"), title=of("title"), company=of("company_name"), location_text=of("candidate_required_location"), remote_hint=F.lit(True), date_posted=of("publication_date"),
        employment_type=of("job_type"), industry=of("category"), description_html=of("description"), skills_text=F.coalesce(joined(REMOTIVE.other("tags")), F.lit("")), salary_text=of("salary"),
    )


#: Sources with a shape of their own and the objects they are read from; all others are read as schema.org postings.
ADAPTERS = {"reliefweb": (reliefweb, [RELIEFWEB_PAGE, RELIEFWEB]), "jsearch": (jsearch, [JSEARCH, JSEARCH_SEEN]), "jooble": (jooble, [JOOBLE]), "remotive": (remotive, [REMOTIVE])}
DEFAULT = (schema_org, [PAGE, POSTING])


def adapt(rows: DataFrame, payload: str = "payload", source: str = "source") -> DataFrame:
    """Rows with the common columns added, in projections over rows that are read once. Each object of
    the payload is opened once, in rows of its source, into a column: every look for a field, or at a
    kind, would walk the whole object again. What a column takes from it is then an expression of
    its own, which is left out where nobody asks for the column."""
    kept = [c for c in rows.columns if c != payload]
    other = F.coalesce(~F.col(source).isin(list(ADAPTERS)), F.lit(True))
    objects = [(f, other) for f in DEFAULT[1]] + [(f, F.col(source) == name) for name, (_, fields) in ADAPTERS.items() for f in fields]
    rows = rows.select(*kept, payload, *[F.when(of, f.opened(F.col(payload))).alias(f.column) for f, of in objects])
    rows = rows.select(*kept, *[f.column for f, _ in objects], *[f.reopened(F.col(payload)) for f, _ in objects])
    shapes = {name: project() for name, (project, _) in ADAPTERS.items()}
    default = {c: F.lit(None).cast("string") for c in COMMON} | {"remote_hint": F.lit(False), "skills_text": F.lit("")}
    columns = default | DEFAULT[0]()
    for name, shape in shapes.items():
        columns |= {c: F.when(F.col(source) == name, shape.get(c, default[c])).otherwise(columns[c]) for c in COMMON}
    return rows.select(*kept, *[columns[c].alias(c) for c in COMMON])


#: Places from which remote work is open to the region.
REMOTE_REGIONS = ["kenya", "africa", "worldwide", "anywhere", "emea"]


def open_to_region(place: Column) -> Column:
    low = F.lower(F.coalesce(place, F.lit("")))
    return F.exists(F.array(*[F.lit(r) for r in REMOTE_REGIONS]), lambda r: F.contains(low, r))


def fingerprint(employer: Column, title: Column, place: Column) -> Column:
    """A stable key of a posting without one; null unless employer and title are known."""
    from tidemark.functions.text import norm_text

    whole = F.concat_ws("|", norm_text(employer), norm_text(title), norm_text(place))
    return F.when((norm_text(employer) != "") & (norm_text(title) != ""), F.left(F.sha1(whole), F.lit(20)))
