"""Registered queries: Z-ordered layouts (P34), upserts of touched files (S14) and
tables by year (S15)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dimstack.operators import matches as mt
from dimstack.plans.clustering import file_ranges, read_touched
from dimstack.plans.days import materialize
from dimstack.plans.layout import layout_report, written_layouts
from dimstack.session import checkpoint_path
from dimstack.sources import filetable, standins as si
from dimstack.sources.tables import read_table
from dimstack.sources.years import read_between, write_by_year

from .common import finalize

Z_COLS = ["user_id", "event_date"]
#: A two-column filter: a few days, a few users.
Z_WHERE = {"user_id": (20, 40), "event_date": ("2024-01-10", "2024-01-14")}
FIRST_DAY, LAST_DAY = "1996-11-15", "1998-02-10"


def _events(spark, sf_dir):
    return mt.event_device_left(si.web_events(spark, sf_dir), si.devices(spark, sf_dir))


def q_layout_zorder(spark, sf_dir):
    return finalize(layout_report(spark, _events(spark, sf_dir), partition_col="event_date", sorts={"unsorted": []},
                                  global_sorts={"date_user": ["event_date", "user_id"]}, z_orders={"z_user_date": Z_COLS}))


def q_zorder_skipping(spark, sf_dir):
    """The filter's rows, read from the files it touches."""
    path = written_layouts(spark, _events(spark, sf_dir), partition_col="event_date", sorts={},
                           z_orders={"z": Z_COLS}, partitions=16)["z"]
    ranges = materialize(file_ranges(spark, path, Z_COLS), "file_ranges")
    where = {c: tuple(F.lit(v).cast("date") if c == "event_date" else v for v in pair) for c, pair in Z_WHERE.items()}
    return finalize(read_touched(spark, path, ranges, where).select("event_id", "user_id", "event_date", "host"))


def _totals(orders):
    """One row per customer: orders, the newest order, and their year's end."""
    return orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderkey").alias("last_order"))


def q_upsert_touched_files(spark, sf_dir):
    """Customer totals up to 1998 by key ranges; a stopped upsert changes nothing,
    its repetition brings the customers with a key over two thirds up to date."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    path = checkpoint_path(spark, "filetables", uuid.uuid4().hex[:10])
    before = _totals(orders.where(F.year("o_orderdate") <= 1998))
    filetable.create(spark, before.repartitionByRange("o_custkey"), path)
    edge = read_table(spark, sf_dir, "customer").agg(F.max("c_custkey") * 2 / 3).first()[0] or 0
    updates = materialize(_totals(orders.where(F.col("o_custkey") > edge)), "upsert_updates")
    filetable.prepare_upsert(spark, path, updates, ["o_custkey"])  # stopped before its commit
    filetable.upsert(spark, path, updates, ["o_custkey"])
    return finalize(filetable.read(spark, path))


def q_orders_between(spark, sf_dir):
    """Orders per priority between two days, from a table by year."""
    path = checkpoint_path(spark, "by_year", uuid.uuid4().hex[:10])
    write_by_year(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority"), path,
                  "o_orderdate", files_per_year=4)
    rows = read_between(spark, path, "o_orderdate", FIRST_DAY, LAST_DAY)
    return finalize(rows.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.min("o_orderkey").alias("first_order"), F.max("o_orderkey").alias("last_order")))


QUERIES = {
    "layout_zorder": q_layout_zorder,
    "zorder_skipping": q_zorder_skipping,
    "upsert_touched_files": q_upsert_touched_files,
    "orders_between": q_orders_between,
}
