"""SQL-callable functions (U02) for users who write SQL text.

Registered as SQL user-defined functions (``CREATE TEMPORARY FUNCTION ...
RETURN <expr>``): the body is a SQL expression that Catalyst inlines, so the
functions stay inside whole-stage codegen (no Python worker).  The bodies
are generated from the same fixed values as the Column builders.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import CLASS_FALLBACK, QUALITY_THRESHOLDS, SCORING_THRESHOLDS
from .scalar import CHANNEL_RULES


def _case(arg: str, thresholds) -> str:
    whens = " ".join(f"WHEN {arg} > {t} THEN '{label}'" for t, label in thresholds)
    return f"CASE {whens} ELSE '{CLASS_FALLBACK}' END"


def _channel(arg: str) -> str:
    whens = " ".join(f"WHEN {arg} LIKE '{p}' THEN '{label}'" for p, label in CHANNEL_RULES)
    return f"CASE {whens} ELSE {arg} END"


FUNCTIONS = {
    "scoring_class_of": ("pts DOUBLE", "STRING", _case("pts", SCORING_THRESHOLDS)),
    "quality_class_of": ("rating DOUBLE", "STRING", _case("rating", QUALITY_THRESHOLDS)),
    "referrer_channel": ("referrer STRING", "STRING", _channel("referrer")),
    "hash_bucket_of": ("key STRING, salt STRING, n INT", "BIGINT",
                       "pmod(CAST(conv(substr(md5(concat(key, salt)), 1, 8), 16, 10) AS BIGINT), n)"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the functions for this session; returns their names."""
    for name, (args, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(FUNCTIONS)
