"""No rows are lost: upserts, SCD2 steps, bounded backfills, NULL keys, and a
session that leaves the submitted settings alone."""

import datetime as dt
import os
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from dimstack.operators.cumulative import cumulative_backfill, cumulative_backfill_multi
from dimstack.operators.patterns import running_index, sessions_batch
from dimstack.operators.scd import scd2_incremental
from dimstack.session import checkpoint_path
from dimstack.sources import files
from dimstack.streaming import jobs as sj

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_upsert_keeps_rows_and_refuses_other_columns(spark):
    path = checkpoint_path(spark, "tests", uuid.uuid4().hex)
    cols = "k int, v string, note string, m string"
    files.upsert_partitions(spark, spark.createDataFrame(
        [(1, "a", "n1", "m1"), (2, "b", "n2", "m1"), (None, "c", "n3", "m1")], cols), path, ["k"], ["m"])
    with pytest.raises(ValueError):
        files.upsert_partitions(spark, spark.createDataFrame([(1, "x", "m1")], "k int, v string, m string"),
                                path, ["k"], ["m"])
    files.upsert_partitions(spark, spark.createDataFrame(
        [(1, "x", "new", "m1"), (None, "y", "new", "m1")], cols), path, ["k"], ["m"])
    got = sorted((str(r.k), r.v, r.note) for r in spark.read.parquet(path).collect())
    assert got == [("1", "x", "new"), ("2", "b", "n2"), ("None", "y", "new")]
    parent, name = os.path.split(path.removeprefix("file:"))
    assert [x for x in os.listdir(parent) if x.startswith(name + "_staging")] == []


SCD = "k int, c string, start_period int, end_period int"


def _step(spark, rows, snap):
    out = scd2_incremental(spark.createDataFrame(rows, SCD), spark.createDataFrame(snap, "k int, c string"),
                           key="k", attrs=["c"], prev=2000, cur=2001)
    return sorted(tuple(map(str, r[:4])) for r in out.collect())


def test_scd2_step_routes_every_record(spark):
    rows = [(1, "a", 1999, 2000), (2, "a", 1998, 2000), (3, "a", 1997, 1998), (4, "a", 1996, None), (5, "a", 1996, None),
            (6, "a", 2000, 2003), (None, "a", 1999, 2000), (None, "b", 1990, 1991), (8, None, 1999, 2000)]
    snap = [(1, "a"), (2, "b"), (4, "a"), (5, "b"), (7, "z"), (8, None)]
    got = _step(spark, rows, snap)
    want = [(1, "a", 1999, 2001), (2, "a", 1998, 2000), (2, "b", 2001, 2001), (3, "a", 1997, 1998),
            (4, "a", 1996, None), (5, "a", 1996, 2000), (5, "b", 2001, None), (6, "a", 2000, 2003),
            (7, "z", 2001, 2001), (8, None, 1999, 2001), (None, "a", 1999, 2000), (None, "b", 1990, 1991)]
    assert got == sorted(tuple(map(str, w)) for w in want)


def test_scd2_step_run_twice_is_the_same(spark):
    rows = [(1, "a", 1999, 2000), (2, "a", 1998, 2000), (3, "a", 1997, 1998)]
    snap = [(1, "a"), (2, "b"), (7, "z")]
    once = _step(spark, rows, snap)
    again = [tuple(None if x == "None" else int(x) if x.isdigit() else x for x in r) for r in once]
    assert _step(spark, again, snap) == once


def test_backfill_stops_at_its_last_period(spark):
    rows = spark.createDataFrame([(1, 1999, 21.0), (1, 2003, 5.0), (2, 2003, 9.0), (3, 2001, 1.0)],
                                 "k int, season int, pts double")
    got = cumulative_backfill(rows, key="k", period="season", static_cols=[], struct_cols=["season", "pts"],
                              last_period=2001).collect()
    assert sorted((r.k, r.current_season, len(r.seasons)) for r in got) == \
        [(1, 1999, 1), (1, 2000, 1), (1, 2001, 1), (3, 2001, 1)]
    many = cumulative_backfill_multi(rows.withColumnRenamed("season", "year"), key="k", period="year", static_cols=[],
                                     rating_col="pts", last_period=2001).collect()
    assert sorted((r.k, r.current_year) for r in many) == [(1, 1999), (1, 2000), (1, 2001), (3, 2001)]


def test_null_keys_have_sessions(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("1", "h", t), (None, "h", t), ("1", None, t), (None, None, t), (None, None, t + dt.timedelta(hours=1))]
    ev = spark.createDataFrame(rows, "ip string, host string, event_timestamp timestamp")
    key = lambda r: tuple(map(str, r))
    batch = sessions_batch(ev, ["ip", "host"], gap_seconds=300).select("ip", "host", "session_start", "session_end", "num_events")
    assert sorted(map(key, batch.collect())) == sorted(map(key, sj.sessions(ev, ["ip", "host"], gap="5 minutes").collect()))


def test_running_index_of_a_hot_key_is_spread(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("k"), "id")
    out = running_index(df, key="k", order=["id"], flag=F.col("id") % 3 == 0)
    hot = out.where("k = -1").orderBy("id").collect()
    assert [r["_idx"] for r in hot] == list(range(3600))
    assert hot[-1]["_cum"] == sum(r["id"] % 3 == 0 for r in hot)
    ranged = df.repartitionByRange(8, "k", "id").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ranged) < 4 * 4000 / 8


def test_submitted_settings_stay(tmp_path):
    code = ("from dimstack.session import get_session; s = get_session('x'); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions')); s.stop()")
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS":
                        "--master local[2] --conf spark.sql.shuffle.partitions=333 --conf spark.ui.enabled=false "
                        f"--conf spark.checkpoint.dir=file://{tmp_path} pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=tmp_path)
    assert "GOT local[2] 333" in out.stdout, out.stderr[-800:]
