"""NULLs, duplicates and absent keys made as small literal frames (the
stand-in tables have none of them)."""

import datetime as dt

from pyspark.sql import functions as F

from dimstack.operators import datelist as dl
from dimstack.operators.quality import dedup_events, grain_violations
from dimstack.operators.reduced import upsert
from dimstack.operators.scd import scd2_incremental

D = dt.date


def test_null_users_are_ignored_and_duplicates_collapse(spark):
    ev = spark.createDataFrame([
        (None, dt.datetime(2024, 1, 1, 1)), (1, dt.datetime(2024, 1, 1, 1)),
        (1, dt.datetime(2024, 1, 1, 1)), (1, dt.datetime(2024, 1, 2, 5))],
        "user_id bigint, event_time timestamp")
    st = dl.datelist_backfill(dl.daily_activity(ev, "user_id"), key="user_id", as_of="2024-01-02")
    rows = st.collect()
    assert len(rows) == 1 and rows[0]["dates_active"] == [D(2024, 1, 1), D(2024, 1, 2)]
    assert dedup_events(ev, ["user_id", "event_time"]).count() == 2


def test_scd_incremental_null_attribute_and_absent_key(spark):
    scd = spark.createDataFrame([
        ("a", None, 2000, 2001), ("b", "good", 1999, 2001), ("c", "bad", 1998, 1999)],
        "k string, cls string, start_period int, end_period int")
    snap = spark.createDataFrame([("a", None), ("d", "star")], "k string, cls string")
    out = scd2_incremental(scd, snap, key="k", attrs=["cls"], prev=2001, cur=2002)
    got = sorted(tuple(r) for r in out.select("k", "cls", "start_period", "end_period").collect())
    assert ("a", None, 2000, 2002) in got        # NULL = NULL is unchanged (Q5)
    assert ("b", "good", 1999, 2001) in got      # absent from snapshot: kept (Q6)
    assert ("c", "bad", 1998, 1999) in got       # closed history passes through
    assert ("d", "star", 2002, 2002) in got      # new key
    assert len(got) == 4


def test_grain_violations_and_upsert(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (2, "y", 3)], "a int, b string, v int")
    assert [tuple(r) for r in grain_violations(df, ["a", "b"]).collect()] == [(1, "x", 2)]
    upd = spark.createDataFrame([(2, "y", 9), (3, "z", 1)], "a int, b string, v int")
    got = sorted(tuple(r) for r in upsert(df.where("v <> 2"), upd, ["a", "b"]).collect())
    assert got == [(1, "x", 1), (2, "y", 9), (3, "z", 1)]


def test_device_lists_keep_new_browser(spark):
    prev = spark.createDataFrame(
        [(1, "chrome", [D(2024, 1, 1)], D(2024, 1, 1)), (1, "opera", [D(2024, 1, 1)], D(2024, 1, 1))],
        "user_id bigint, browser_type string, dates_active array<date>, date date")
    today = spark.createDataFrame([(1, "safari", D(2024, 1, 2)), (1, "chrome", D(2024, 1, 2))],
                                  "user_id bigint, browser_type string, date date")
    out = dl.device_datelist_step(prev, today, today="2024-01-02")
    assert {r["browser_type"]: r["dates_active"] for r in out.collect()} == {
        "chrome": [D(2024, 1, 1), D(2024, 1, 2)], "safari": [D(2024, 1, 2)], "opera": [D(2024, 1, 1)]}   # Q17
    assert {r["date"] for r in out.collect()} == {D(2024, 1, 2)}
    bits = dl.any_device_bits(out, start="2024-01-01", end="2024-01-02").collect()
    assert [tuple(r) for r in bits] == [(1, 3, 2)]


def test_bits_compat_drops_today(spark):
    st = spark.createDataFrame([(1, [D(2024, 1, 30), D(2024, 1, 29)])],
                               "user_id bigint, dates_active array<date>")
    fixed = dl.datelist_int(st, key="user_id", as_of="2024-01-30").collect()[0]["datelist_int"]
    compat = dl.datelist_int(st, key="user_id", as_of="2024-01-30",
                             compat=True).collect()[0]["datelist_int"]
    assert fixed == 0xC0000000 and compat == 0x80000000          # Q10
    flags = dl.activity_flags(st.select("user_id", F.lit(fixed).alias("datelist_int")),
                              key="user_id").collect()[0]
    assert flags["l32"] == 2 and flags["l7"] == 2 and flags["weekly_active"]


def test_small_helpers(spark):
    from dimstack.functions.arrays import any_list_contains
    from dimstack.functions.scalar import days_between, split_part
    df = spark.createDataFrame(
        [({"a": [D(2024, 1, 1)], "b": [D(2024, 1, 3)]}, "x y", D(2024, 1, 3))],
        "m map<string,array<date>>, t string, d date")
    r = df.select(any_list_contains(F.col("m"), F.col("d")).alias("hit"),
                  any_list_contains(F.col("m"), F.lit(D(2024, 1, 2))).alias("miss"),
                  split_part("t", " ", 1).alias("second"), split_part("t", " ", 5).alias("none"),
                  days_between(F.col("d"), F.lit(D(2024, 1, 1))).alias("days")).collect()[0]
    assert (r.hit, r.miss, r.second, r.none, r.days) == (True, False, "y", None, 2)


def test_domains(spark):
    from dimstack.schemas import DAILY_STATES, EDGE_TYPES, SEASON_STATES, VERTEX_TYPES, check_domain
    from dimstack.operators.growth import growth_backfill, season_state_changes
    from dimstack.sources import standins as si
    from queries.dimensional import players_state
    sf = "/root/testdata/sf0.001"
    g = growth_backfill(dl.daily_activity(si.web_events(spark, sf), "user_id"), as_of="2024-01-30")
    assert check_domain(g, "daily_active_state", DAILY_STATES).count() == 0
    s = season_state_changes(players_state(spark, sf), key="player_id")
    assert check_domain(s, "season_state", SEASON_STATES).count() == 0
    assert "plays_in" in EDGE_TYPES and "team" in VERTEX_TYPES
