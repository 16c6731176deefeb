"""Which sources may be read, and which postings may be shown."""

from __future__ import annotations

import os
from dataclasses import dataclass


class SourceRefused(RuntimeError):
    """The source must not be read."""


@dataclass(frozen=True)
class Policy:
    status: str  # open, consent_required, unsupported


#: The sources that were looked into, and whether they may be read.
POLICIES = {
    "remotive": Policy("open"),
    "myjobmag": Policy("open"),
    "reliefweb": Policy("open"),
    "jsearch": Policy("open"),
    "jooble": Policy("open"),
    "brightermonday": Policy("consent_required"),
    "fuzu": Policy("consent_required"),
    "adzuna": Policy("unsupported"),
    "oyk": Policy("open"),
}


def require(source: str, policies: dict[str, Policy] = POLICIES, environment=None) -> None:
    """Refuse unknown and unsupported sources, and those whose consent is not on record
    (an environment variable CONSENT_<SOURCE> that is not empty)."""
    environment = os.environ if environment is None else environment
    policy = policies.get(source)
    if policy is None or policy.status == "unsupported":
        raise SourceRefused(f"{source} is not supported")
    if policy.status == "consent_required" and not environment.get(variable := f"CONSENT_{source.upper()}"):
        raise SourceRefused(f"{source} needs consent; record its date in {variable}")


#: Sources whose postings may be shown; sources not listed may not.
PUBLISHABLE = [("myjobmag", True), ("reliefweb", True), ("jsearch", True), ("jooble", True), ("brightermonday", False)]


def publishing_table(spark):
    return spark.createDataFrame(PUBLISHABLE, "source string, publishable boolean")
