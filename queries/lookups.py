"""Registered queries: longest-prefix locations (P39), strongest partners (P10)
and distinct visitors over any span (A03, A05, P20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimstack.operators.locate import locate
from dimstack.operators.partners import strongest_partners
from dimstack.operators.visitors import daily_visitors, visitors_between, visitors_by
from dimstack.plans.days import materialize
from dimstack.sources import standins as si

from .common import finalize

MIN_SHARED = 6


def q_ip_location(spark, sf_dir):
    events = si.web_events(spark, sf_dir).select(
        "event_id", "host", F.when(F.col("event_id") % 50 > 0, si.ip_text(F.col("user_id"))).alias("ip"))
    return finalize(locate(events, si.networks(spark, sf_dir)))


def q_strongest_partners(spark, sf_dir):
    out = strongest_partners(si.game_details(spark, sf_dir), min_shared=MIN_SHARED, order_cols=["line_no", "part_key"])
    return finalize(out)


def q_distinct_visitors(spark, sf_dir):
    """Daily, weekly and monthly counts and one free span, all from the same
    stored table of daily bitmaps."""
    daily = materialize(daily_visitors(si.web_events(spark, sf_dir), ["host"]), "daily_visitors")
    out = visitors_between(daily, ["host"], "2024-01-05", "2024-01-18").select(
        F.lit("5 to 18 January").alias("span"), "host", F.lit("2024-01-05").cast("date").alias("first_day"), "n_visitors")
    for span in ("day", "week", "month"):
        out = out.unionByName(visitors_by(daily, ["host"], span))
    return finalize(out)


QUERIES = {
    "ip_location": q_ip_location,
    "strongest_partners": q_strongest_partners,
    "distinct_visitors": q_distinct_visitors,
}
