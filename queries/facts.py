"""Registered queries: date lists, bit packing, reduced facts."""

from __future__ import annotations

import uuid

import datetime as dt

from pyspark.sql import functions as F

from dimstack.functions.arrays import dates_csv
from dimstack.operators import datelist as dl
from dimstack.operators import reduced as rd
from dimstack.session import checkpoint_path
from dimstack.sources import standins as si
from dimstack.sources.files import upsert_partitions

from .common import AS_OF, MONTH_START, finalize

PREV_DAY = (dt.date.fromisoformat(AS_OF) - dt.timedelta(days=1)).isoformat()


def _user_activity(spark, sf_dir, end=AS_OF):
    return dl.daily_activity(si.web_events(spark, sf_dir), "user_id", end=end)


def _flat_list(df, key, list_col="dates_active"):
    return finalize(df.select(
        key, F.size(list_col).cast("bigint").alias("n_dates"),
        F.col(list_col)[0].alias("first_date"), F.element_at(list_col, -1).alias("last_date"),
        dates_csv(F.col(list_col)).alias("dates"), "date"))


def q_user_datelist(spark, sf_dir):
    ev = si.web_events(spark, sf_dir)
    prev = dl.datelist_backfill(dl.daily_activity(ev, "user_id", end=PREV_DAY), key="user_id",
                                as_of=PREV_DAY)
    today = dl.daily_activity(ev, "user_id", start=AS_OF, end=AS_OF)
    return _flat_list(dl.datelist_step(prev, today, key="user_id", today_date=AS_OF), "user_id")


def q_host_datelist(spark, sf_dir):
    ev = si.web_events(spark, sf_dir)
    prev = dl.datelist_backfill(dl.daily_activity(ev, "host", end=PREV_DAY), key="host",
                                as_of=PREV_DAY)
    today = dl.daily_activity(ev, "host", start=AS_OF, end=AS_OF)
    return _flat_list(dl.datelist_step(prev, today, key="host", today_date=AS_OF), "host")


def _bits(spark, sf_dir, compat=False):
    state = dl.datelist_backfill(_user_activity(spark, sf_dir), key="user_id", as_of=AS_OF)
    return dl.datelist_int(state, key="user_id", as_of=AS_OF, compat=compat)


def q_datelist_int(spark, sf_dir):
    return finalize(_bits(spark, sf_dir))


def q_datelist_int_compat(spark, sf_dir):
    return finalize(_bits(spark, sf_dir, compat=True))


def q_activity_flags(spark, sf_dir):
    return finalize(dl.activity_flags(_bits(spark, sf_dir), key="user_id"))


def _device_state(spark, sf_dir, as_of=AS_OF):
    act = dl.browser_activity(si.web_events(spark, sf_dir), si.devices(spark, sf_dir), end=as_of)
    return dl.device_datelist_backfill(act, as_of=as_of)


def q_device_datelist(spark, sf_dir):
    ev, dev = si.web_events(spark, sf_dir), si.devices(spark, sf_dir)
    prev = dl.device_datelist_backfill(dl.browser_activity(ev, dev, end=PREV_DAY), as_of=PREV_DAY)
    today = dl.browser_activity(ev, dev, day=AS_OF)
    state = dl.device_datelist_step(prev, today, today=AS_OF)
    return finalize(state.select(
        "user_id", "browser_type", F.size("dates_active").cast("bigint").alias("n_dates"),
        F.col("dates_active")[0].alias("first_date"),
        F.element_at("dates_active", -1).alias("last_date"),
        dates_csv(F.col("dates_active")).alias("dates"), "date"))


def q_device_day_matrix(spark, sf_dir):
    m = dl.device_day_matrix(_device_state(spark, sf_dir), start=MONTH_START, end=AS_OF)
    return finalize(m.select("user_id", "browser_type",
                             F.array_join(F.col("datelist_int_array").cast("array<string>"), ",")
                             .alias("datelist_int_array"), "bit_count"))


def q_any_device_bits(spark, sf_dir):
    return finalize(dl.any_device_bits(_device_state(spark, sf_dir), start=MONTH_START, end=AS_OF))


def _csv(col, null="null"):
    return F.array_join(F.transform(col, lambda x: F.coalesce(x.cast("string"), F.lit(null))), ",")


def q_monthly_hits(spark, sf_dir):
    act = _user_activity(spark, sf_dir)
    prev = rd.monthly_hits_backfill(act, key="user_id", month_start=MONTH_START, day=PREV_DAY)
    today = act.where(F.col("date") == F.to_date(F.lit(AS_OF)))
    s = rd.monthly_hits_step(prev, today, key="user_id", month_start=MONTH_START, day=AS_OF)
    return finalize(s.select(
        "user_id", "month_start", "first_found_date", "date_partition",
        F.size("hit_array").cast("bigint").alias("n_days"),
        F.aggregate("hit_array", F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))
        .alias("hits_total"),
        _csv(F.col("hit_array")).alias("hits")))


def q_first_days_totals(spark, sf_dir):
    snap = rd.monthly_hits_backfill(_user_activity(spark, sf_dir), key="user_id",
                                    month_start=MONTH_START, day=AS_OF)
    return finalize(rd.first_days_totals(snap, n=3))


def _site_hits(spark, sf_dir):
    return _user_activity(spark, sf_dir).withColumnRenamed("n_events", "site_hits")


def q_metric_array(spark, sf_dir):
    per_day = _site_hits(spark, sf_dir)
    prev = rd.metric_array_backfill(per_day, key=["user_id"], metrics=["site_hits"],
                                    month_start=MONTH_START, day=PREV_DAY)
    today = per_day.where(F.col("date") == F.to_date(F.lit(AS_OF)))
    s = rd.metric_array_step(prev, today, key=["user_id"], metrics=["site_hits"],
                             month_start=MONTH_START, day=AS_OF)
    return finalize(s.select(
        "user_id", "month_start", F.lit("site_hits").alias("metric_name"),
        F.size("site_hits").cast("bigint").alias("n_days"),
        F.aggregate("site_hits", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        _csv(F.col("site_hits")).alias("metric_array")))


def q_metric_array_upsert(spark, sf_dir):
    """The step's rows upserted into the table that holds yesterday's state."""
    per_day = _site_hits(spark, sf_dir)
    path = checkpoint_path(spark, "tables", f"metric_array_{uuid.uuid4().hex[:10]}")
    keys = {"key": ["user_id"], "metrics": ["site_hits"], "month_start": MONTH_START}
    upsert_partitions(spark, rd.metric_array_backfill(per_day, day=PREV_DAY, **keys), path,
                      ["user_id"], ["month_start"])
    stored = spark.read.parquet(path)
    today = per_day.where(F.col("date") == F.to_date(F.lit(AS_OF)))
    step = rd.metric_array_step(stored, today, day=AS_OF, **keys)
    upsert_partitions(spark, step.select(*stored.columns), path, ["user_id"], ["month_start"])
    s = spark.read.parquet(path)
    return finalize(s.select(
        "user_id", "month_start", F.lit("site_hits").alias("metric_name"),
        F.size("site_hits").cast("bigint").alias("n_days"),
        F.aggregate("site_hits", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        _csv(F.col("site_hits")).alias("metric_array")))


def host_daily(spark, sf_dir):
    ev = dl.in_days(si.web_events(spark, sf_dir), start=MONTH_START, end=AS_OF) \
        .where(F.col("user_id").isNotNull() & F.col("host").isNotNull())
    return ev.groupBy("host", F.to_date("event_time").alias("date")).agg(
        F.count(F.lit(1)).alias("hit_array"), F.count_distinct("user_id").alias("unique_visitors"))


def q_host_activity_reduced(spark, sf_dir):
    per_day = host_daily(spark, sf_dir)
    metrics = ["hit_array", "unique_visitors"]
    prev = rd.metric_array_backfill(per_day, key=["host"], metrics=metrics,
                                    month_start=MONTH_START, day=PREV_DAY)
    today = per_day.where(F.col("date") == F.to_date(F.lit(AS_OF)))
    s = rd.metric_array_step(prev, today, key=["host"], metrics=metrics,
                             month_start=MONTH_START, day=AS_OF)
    return finalize(s.select("host", "month_start",
                             F.size("hit_array").cast("bigint").alias("n_days"),
                             _csv(F.col("hit_array")).alias("hit_array"),
                             _csv(F.col("unique_visitors")).alias("unique_visitors")))


def q_metric_daily(spark, sf_dir):
    state = rd.metric_array_backfill(_site_hits(spark, sf_dir), key=["user_id"],
                                     metrics=["site_hits"], month_start=MONTH_START, day=AS_OF)
    state = state.withColumn("metric_name", F.lit("site_hits"))
    return finalize(rd.metric_daily(state, group=["metric_name"], array_col="site_hits"))


QUERIES = {
    "user_datelist": q_user_datelist,
    "datelist_int": q_datelist_int,
    "datelist_int_compat": q_datelist_int_compat,
    "activity_flags": q_activity_flags,
    "device_datelist": q_device_datelist,
    "device_day_matrix": q_device_day_matrix,
    "any_device_bits": q_any_device_bits,
    "host_datelist": q_host_datelist,
    "monthly_hits": q_monthly_hits,
    "metric_array": q_metric_array,
    "metric_array_upsert": q_metric_array_upsert,
    "host_activity_reduced": q_host_activity_reduced,
    "metric_daily": q_metric_daily,
    "first_days_totals": q_first_days_totals,
}
