"""Explicit schemas, domains and fixed values.

PostgreSQL ENUMs become STRING columns with a domain check; composite types
become named structs (field order is by name, never by position).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: class labels and thresholds (must equal the reference) ---
# scoring_class by points: > 20 star, > 15 good, > 10 average, else bad
SCORING_THRESHOLDS = ((20.0, "star"), (15.0, "good"), (10.0, "average"))
# quality_class by rating: > 8 star, > 7 good, > 6 average, else bad
QUALITY_THRESHOLDS = ((8.0, "star"), (7.0, "good"), (6.0, "average"))
CLASS_FALLBACK = "bad"
SCORING_CLASSES = ("bad", "average", "good", "star")
VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")
# growth-accounting states
DAILY_STATES = ("New", "Retained", "Resurrected", "Churned", "Stale")
# season state changes
SEASON_STATES = ("New", "Retired", "Continued Playing", "Returned from Retirement",
                 "Stayed Retired")
# grouping-sets dashboard labels
OVERALL = "(overall)"
UNKNOWN = "unknown"
ALL_LEVELS_LABEL = "os_type__device_type__browser"
UNKNOWN_DEVICE_PREFIX = "UNKNOWN_DEVICE_"
# experiment defaults
EXPOSURE_EVENT = "visited_signup"
DEFAULT_PARAMS = {"Button Color": "blue", "Paragraph Text": "Data Engineering Boot Camp"}
# event-time text pattern of the stream source (ISO with millis and literal Z)
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
# --- end of fixed values ---

WEB_EVENT_JSON = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("headers", T.StringType()),
    T.StructField("event_time", T.StringType()),
])

EVENTS_DRIVER = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

DEVICES = T.StructType([
    T.StructField("device_id", T.LongType(), False),
    T.StructField("browser_type", T.StringType()),
    T.StructField("os_type", T.StringType()),
    T.StructField("device_type", T.StringType()),
])


def check_domain(df, column: str, domain) -> "DataFrame":  # noqa: F821
    """Rows whose ``column`` is outside ``domain`` (ENUM check); empty when clean."""
    from pyspark.sql import functions as F
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(domain)))
