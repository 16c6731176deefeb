"""Session settings that the engine's semantics rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """UTC, ANSI and adaptive execution; everything else is left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for key, value in (fixed | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
