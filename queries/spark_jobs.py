"""Registered queries: match statistics, layout reports, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimstack.operators import matches as mt
from dimstack.operators.patterns import top_per_level
from dimstack.plans.days import materialize
from dimstack.plans.layout import bucket_join_report, layout_report
from dimstack.sources import standins as si

from .common import finalize


def _match_stats(spark, sf_dir):
    return mt.match_stats(si.matches(spark, sf_dir), si.match_details(spark, sf_dir),
                          si.medals_matches_players(spark, sf_dir), si.medals(spark, sf_dir),
                          si.maps(spark, sf_dir))


def q_match_stats(spark, sf_dir):
    return finalize(_match_stats(spark, sf_dir))


def q_match_leaders(spark, sf_dir):
    return finalize(top_per_level(_match_stats(spark, sf_dir), level_col="metric",
                                  metric="value", label_cols=["key"]))


def q_bucket_join_report(spark, sf_dir):
    return finalize(bucket_join_report(
        spark, si.match_details(spark, sf_dir), si.matches(spark, sf_dir),
        si.medals_matches_players(spark, sf_dir).select("match_id", "medal_id", "count"), buckets=16))


def q_layout_report(spark, sf_dir):
    df = mt.event_device_left(si.web_events(spark, sf_dir), si.devices(spark, sf_dir))
    return finalize(layout_report(spark, df, partition_col="event_date",
                                  global_sorts={"global_date_host": ["event_date", "host"]},
                                  sorts={"unsorted": [], "date_host": ["event_date", "host"],
                                         "host_url_date": ["host", "url", "event_date"]}))


def q_typed_enrichment(spark, sf_dir):
    return finalize(mt.typed_enrichment(si.web_events(spark, sf_dir), si.devices(spark, sf_dir)))


def _shared(spark, sf_dir):
    return mt.shared_aggregate(si.web_events(spark, sf_dir), si.devices(spark, sf_dir),
                               persist=False)


def q_shared_aggregate_users(spark, sf_dir):
    users, _, _ = _shared(spark, sf_dir)
    return finalize(users)


def q_shared_aggregate_devices(spark, sf_dir):
    _, devs, _ = _shared(spark, sf_dir)
    return finalize(devs)


def q_shared_aggregate_job(spark, sf_dir):
    """Both outputs in one job over one stored aggregate."""
    agg = materialize(mt.events_aggregated(si.web_events(spark, sf_dir)), "shared_aggregate")
    users = agg.groupBy("user_id").agg(F.count("device_id").alias("n_others"), F.sum("event_counts").alias("n_events"))
    devs = (si.devices(spark, sf_dir).select("device_id", "device_type").join(agg, "device_id")
            .groupBy("device_id", "device_type")
            .agg(F.count(F.lit(1)).alias("n_others"), F.sum("event_counts").alias("n_events")))
    sides = [df.select(F.lit(side).alias("side"), F.col(key).cast("string").alias("id"), "n_others", "n_events")
             for side, key, df in (("user", "user_id", users), ("device", "device_id", devs))]
    return finalize(sides[0].unionByName(sides[1]))


def q_event_device_left(spark, sf_dir):
    return finalize(mt.event_device_left(si.web_events(spark, sf_dir), si.devices(spark, sf_dir)))


QUERIES = {
    "match_stats": q_match_stats,
    "match_leaders": q_match_leaders,
    "bucket_join_report": q_bucket_join_report,
    "layout_report": q_layout_report,
    "typed_enrichment": q_typed_enrichment,
    "shared_aggregate_users": q_shared_aggregate_users,
    "shared_aggregate_devices": q_shared_aggregate_devices,
    "shared_aggregate_job": q_shared_aggregate_job,
    "event_device_left": q_event_device_left,
}
