"""Scalar Column builders (C01-C22).  All are built-in Spark expressions, so
they stay inside whole-stage codegen; no Python UDF runs on a batch path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CLASS_FALLBACK, QUALITY_THRESHOLDS, SCORING_THRESHOLDS

# fixed values: referrer → channel rules, first match wins
NETWORK_RULES = (
    ("%linkedin%", "Linkedin"),
    ("%t.co%", "Twitter"),
    ("%google%", "Google"),
    ("%lnkd%", "Linkedin"),
)
#: Referrers that are the site itself (of the stand-in data).
ON_SITE = ("%home.example%", "%second-home.example%")


def channel_rules(on_site=ON_SITE) -> tuple:
    """The rules with a site's own referrer patterns last."""
    return (*NETWORK_RULES, *((pattern, "On Site") for pattern in on_site))


CHANNEL_RULES = channel_rules()
# mask of the 7 most significant of 32 bits, and of the 7 below them
TOP7_MASK = 4261412864
NEXT7_MASK = 33292288
LOW32_MASK = 4294967295


def classify(value: Column | str, thresholds=SCORING_THRESHOLDS,
             fallback: str = CLASS_FALLBACK) -> Column:
    """Ordered CASE WHEN value > t THEN label ... ELSE fallback."""
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for t, label in thresholds:
        expr = F.when(v > t, label) if expr is None else expr.when(v > t, label)
    return expr.otherwise(fallback)


def scoring_class(value) -> Column:
    return classify(value, SCORING_THRESHOLDS)


def quality_class(value) -> Column:
    return classify(value, QUALITY_THRESHOLDS)


def channel(referrer: Column | str, rules=CHANNEL_RULES) -> Column:
    """Map a referrer URL to a channel by the first matching LIKE; else itself."""
    r = F.col(referrer) if isinstance(referrer, str) else referrer
    expr = None
    for pattern, label in rules:
        expr = F.when(r.like(pattern), label) if expr is None else expr.when(r.like(pattern), label)
    return expr.otherwise(r)


def days_between(later, earlier) -> Column:
    """date − date as BIGINT days (C11; Spark's ``-`` gives an interval)."""
    return F.datediff(later, earlier).cast("bigint")


def bit_count(bits: Column) -> Column:
    return F.bit_count(bits).cast("bigint")


def hash_bucket(key: Column, salt: str = "", buckets: int = 100) -> Column:
    """Stable bucket 0..buckets-1 from the first 32 bits of md5(key || salt)
    (C21); unlike a per-process salted hash it survives restarts."""
    h = F.md5(F.concat(key.cast("string"), F.lit(salt)))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def parse_event_time(text: Column | str, pattern: str | None = None) -> Column:
    """TO_TIMESTAMP(text, ISO millis 'Z') → TIMESTAMP, NULL on bad input (C14)."""
    from ..schemas import EVENT_TIME_PATTERN
    t = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(t, F.lit(pattern or EVENT_TIME_PATTERN))


def split_part(text: Column | str, sep: str = " ", index: int = 0) -> Column:
    """split(text, sep)[index] without raising on short input."""
    t = F.col(text) if isinstance(text, str) else text
    return F.get(F.split(t, sep), index)
