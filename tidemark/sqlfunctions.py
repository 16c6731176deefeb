"""The engine's functions for SQL texts: register them once a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.functions import classify
from tidemark.functions.stats import Z

_HALF = f"{Z} * sqrt((k / n) * (1 - k / n) / n + {Z * Z} / (4D * n * n))"
_MIDDLE, _SCALE = f"(k / n + {Z * Z} / (2D * n))", f"(1 + {Z * Z} / n)"


def _category() -> str:
    chain = [f"WHEN {column} RLIKE r'{classify.whole_words(rule[at])}' THEN '{rule[1]}'" for at, column in ((2, "title"), (3, "industry")) for rule in sorted(classify.RULES) if rule[at]]
    return f"CASE {' '.join(chain)} ELSE '{classify.OTHER}' END"


#: Steps of the product-limit curve of subjects that were counted by duration and event.
_CURVE = """WITH seen AS (SELECT inline(transform(durations, (x, i) -> named_struct('d', x, 'e', events[i], 'm', {number})))),
 steps AS (SELECT d AS t, sum(m) AS c, coalesce(sum(CASE WHEN e THEN m END), 0) AS n_events FROM seen GROUP BY d),
 risk AS (SELECT t, n_events, sum(c) OVER (ORDER BY t DESC ROWS UNBOUNDED PRECEDING) AS at_risk FROM steps)
 SELECT t, at_risk, n_events, exp(sum(ln(greatest(1 - n_events / at_risk, 1e-9))) OVER (ORDER BY t ROWS UNBOUNDED PRECEDING)) FROM risk"""
_STEP = "TABLE(t INT, at_risk BIGINT, n_events BIGINT, survival DOUBLE)"

FUNCTIONS = {
    "date_key(d DATE)": ("INT", "year(d) * 10000 + month(d) * 100 + day(d)"),
    "classify_category(title STRING, industry STRING)": ("STRING", _category()),
    "wilson_low(k DOUBLE, n DOUBLE)": ("DOUBLE", f"CASE WHEN n > 0 THEN greatest(0D, ({_MIDDLE} - {_HALF}) / {_SCALE}) END"),
    "wilson_high(k DOUBLE, n DOUBLE)": ("DOUBLE", f"CASE WHEN n > 0 THEN least(1D, ({_MIDDLE} + {_HALF}) / {_SCALE}) END"),
    "km_survival(durations ARRAY<INT>, events ARRAY<BOOLEAN>)": (_STEP, _CURVE.format(number="1L")),
    "km_survival_counted(durations ARRAY<INT>, events ARRAY<BOOLEAN>, counts ARRAY<BIGINT>)": (_STEP, _CURVE.format(number="counts[i]")),
}


def register(spark: SparkSession) -> None:
    """Scalar functions and table functions; the latter stand behind LATERAL, a row's arrays to a
    curve. ``km_survival_counted`` takes subjects that are counted by duration and event, so that its
    arrays are as long as there are durations, not subjects."""
    for signature, (returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")
