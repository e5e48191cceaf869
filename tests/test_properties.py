"""Properties between jobs: incremental steps folded over days
equal the one-shot backfills; re-aimed jobs equal brute force on a small
fixture."""

import datetime as dt

from pyspark.sql import functions as F

from dimstack.operators import datelist as dl
from dimstack.operators import growth as gr
from dimstack.operators import reduced as rd
from dimstack.operators import scd
from dimstack.operators.graph import player_partner_totals
from dimstack.operators.quality import first_per_key
from dimstack.plans.days import day_range, run_days
from dimstack.session import checkpoint_path
from dimstack.sources import standins as si
from queries.dimensional import players_state

SF = "/root/testdata/sf0.001"


def _rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_datelist_day_loop_equals_backfill(spark):
    ev = si.web_events(spark, SF)
    days = day_range("2024-01-01", "2024-01-06")
    path = checkpoint_path(spark, "tests", f"datelist_{dt.datetime.now().timestamp()}")

    def step(prev, day):
        today = dl.daily_activity(ev, "user_id", start=day, end=day)
        if prev is None:
            prev = spark.createDataFrame([], "user_id bigint, dates_active array<date>, date date")
        return dl.datelist_step(prev, today, key="user_id", today_date=day)

    table = run_days(spark, step, days, path)
    last = table.where(F.col("date") == F.to_date(F.lit(days[-1])))
    back = dl.datelist_backfill(dl.daily_activity(ev, "user_id"), key="user_id", as_of=days[-1])
    cols = ["user_id", "dates_active"]
    assert _rows(last.select(*cols), ["user_id"]) == _rows(back.select(*cols), ["user_id"])
    # one partition per day was written
    assert table.select("date").distinct().count() == len(days)


def test_growth_steps_equal_backfill(spark):
    act = dl.daily_activity(si.web_events(spark, SF), "user_id")
    days = day_range("2024-01-10", "2024-01-13")
    prev = gr.growth_backfill(act, as_of=days[0]).where(F.col("date") == F.to_date(F.lit(days[0])))
    for day in days[1:]:
        today = act.where(F.col("date") == F.to_date(F.lit(day)))
        prev = gr.growth_step(prev, today, today_date=day)
    back = gr.growth_backfill(act, as_of=days[-1]).where(F.col("date") == F.to_date(F.lit(days[-1])))
    cols = ["user_id", "first_active_date", "last_active_date", "daily_active_state",
            "weekly_active_state", "dates_active", "date"]
    assert _rows(prev.select(*cols), ["user_id"]) == _rows(back.select(*cols), ["user_id"])


def test_growth_states_partition_users(spark):
    act = dl.daily_activity(si.web_events(spark, SF), "user_id")
    g = gr.growth_backfill(act, as_of="2024-01-30")
    bad = g.where(~F.col("daily_active_state").isin("New", "Retained", "Resurrected", "Churned",
                                                   "Stale"))
    assert bad.count() == 0
    assert g.groupBy("user_id", "date").count().where("count > 1").count() == 0


def test_scd_incremental_equals_backfill(spark):
    state = players_state(spark, SF)
    attrs = ["scoring_class", "is_active"]
    for n in (1998, 2000):
        prev = scd.scd2_backfill(state, key="player_id", attrs=attrs, period="current_season",
                                 as_of=n - 1)
        snap = state.where(F.col("current_season") == n)
        inc = scd.scd2_incremental(prev, snap, key="player_id", attrs=attrs, prev=n - 1, cur=n)
        back = scd.scd2_backfill(state, key="player_id", attrs=attrs, period="current_season",
                                 as_of=n)
        cols = ["player_id", *attrs, "start_period", "end_period"]
        assert _rows(inc.select(*cols), cols) == _rows(back.select(*cols), cols)


def test_metric_array_rerun_is_idempotent(spark):
    per_day = dl.daily_activity(si.web_events(spark, SF), "user_id") \
        .withColumnRenamed("n_events", "site_hits")
    prev = rd.metric_array_backfill(per_day, key=["user_id"], metrics=["site_hits"],
                                    month_start="2024-01-01", day="2024-01-09")
    today = per_day.where(F.col("date") == F.to_date(F.lit("2024-01-10")))
    once = rd.metric_array_step(prev, today, key=["user_id"], metrics=["site_hits"],
                                month_start="2024-01-01", day="2024-01-10")
    twice = rd.metric_array_step(once, today, key=["user_id"], metrics=["site_hits"],
                                 month_start="2024-01-01", day="2024-01-10")
    assert _rows(once, ["user_id"]) == _rows(twice, ["user_id"])
    closed = rd.metric_array_backfill(per_day, key=["user_id"], metrics=["site_hits"],
                                      month_start="2024-01-01", day="2024-01-10")
    assert _rows(once.select("user_id", "site_hits"), ["user_id"]) == \
        _rows(closed.select("user_id", "site_hits"), ["user_id"])


def test_metric_daily_equals_group_by(spark):
    per_day = dl.daily_activity(si.web_events(spark, SF), "user_id") \
        .withColumnRenamed("n_events", "site_hits")
    state = rd.metric_array_backfill(per_day, key=["user_id"], metrics=["site_hits"],
                                     month_start="2024-01-01", day="2024-01-30")
    daily = rd.metric_daily(state, group=[], array_col="site_hits")
    direct = per_day.groupBy("date").agg(F.sum("site_hits").cast("bigint").alias("value"))
    got = {r["date"]: r["value"] for r in daily.collect() if r["value"]}
    want = {r["date"]: r["value"] for r in direct.collect()}
    assert got == want


def test_partner_totals_equal_brute_force_pairs(spark):
    d = first_per_key(si.game_details(spark, SF), ["player_id", "game_id"], ["line_no", "part_key"])
    got = player_partner_totals(si.game_details(spark, SF), order_cols=["line_no", "part_key"])
    # brute force on the small fixture: the reference's pair table, summed per player
    a, b = d.alias("a"), d.alias("b")
    pairs = a.join(b, (F.col("a.game_id") == F.col("b.game_id"))
                   & (F.col("a.player_name") != F.col("b.player_name"))).select(
        F.col("a.player_id").alias("player_id"), F.col("a.player_name").alias("player_name"),
        F.when(F.col("a.team_abbreviation") == F.col("b.team_abbreviation"), "shares_team")
        .otherwise("plays_against").alias("edge_type"),
        F.col("a.pts").alias("own"), F.col("b.pts").alias("other"))
    want = pairs.groupBy("player_id", "player_name", "edge_type").agg(
        F.count(F.lit(1)).alias("partner_games"), F.sum("own").alias("own_points"),
        F.sum("other").alias("partner_points"))
    cols = ["player_id", "player_name", "edge_type", "partner_games", "own_points",
            "partner_points"]
    assert _rows(got.select(*cols), cols) == _rows(want.select(*cols), cols)


def test_day_loop_resumes_without_recomputing(spark):
    ev = si.web_events(spark, SF)
    days = day_range("2024-01-01", "2024-01-04")
    path = checkpoint_path(spark, "tests", f"resume_{dt.datetime.now().timestamp()}")
    calls = []

    def step(prev, day):
        calls.append(day)
        today = dl.daily_activity(ev, "user_id", start=day, end=day)
        if prev is None:
            prev = spark.createDataFrame([], "user_id bigint, dates_active array<date>, date date")
        return dl.datelist_step(prev, today, key="user_id", today_date=day)

    run_days(spark, step, days[:2], path)            # "fails" after two days
    table = run_days(spark, step, days, path, resume=True)
    assert calls == days[:2] + days[2:]              # days 1-2 were not recomputed
    full = dl.datelist_backfill(dl.daily_activity(ev, "user_id"), key="user_id", as_of=days[-1])
    last = table.where(F.col("date") == F.to_date(F.lit(days[-1])))
    assert _rows(last.select("user_id", "dates_active"), ["user_id"]) == \
        _rows(full.select("user_id", "dates_active"), ["user_id"])


def test_shared_aggregate_is_cached_and_released(spark):
    from pyspark import StorageLevel

    from dimstack.operators.matches import shared_aggregate
    users, devices, agg = shared_aggregate(si.web_events(spark, SF), si.devices(spark, SF))
    assert agg.storageLevel == StorageLevel.MEMORY_AND_DISK
    assert users.count() > 0 and devices.count() > 0
    agg.unpersist()
    assert agg.storageLevel == StorageLevel(False, False, False, False, 1)


def test_bucketed_state_table_day_loop(spark):
    from dimstack.plans.days import create_state_table
    from dimstack.plans.inspect import plan_text
    ev = si.web_events(spark, SF)
    days = day_range("2024-01-01", "2024-01-03")
    name = f"users_cumulated_{int(dt.datetime.now().timestamp() * 1000)}"
    create_state_table(spark, name, "user_id BIGINT, dates_active ARRAY<DATE>", key="user_id",
                       buckets=4, path=checkpoint_path(spark, "tests", name))
    plans = []

    def step(prev, day):
        today = dl.daily_activity(ev, "user_id", start=day, end=day)
        if prev is None:
            prev = spark.createDataFrame([], "user_id bigint, dates_active array<date>, date date")
        out = dl.datelist_step(prev, today, key="user_id", today_date=day)
        plans.append(plan_text(out, "simple"))
        return out

    try:
        table = run_days(spark, step, days, table=name)
        last = table.where(F.col("date") == F.to_date(F.lit(days[-1])))
        back = dl.datelist_backfill(dl.daily_activity(ev, "user_id"), key="user_id", as_of=days[-1])
        assert _rows(last.select("user_id", "dates_active"), ["user_id"]) == \
            _rows(back.select("user_id", "dates_active"), ["user_id"])
        # from day 2 on the state is read bucketed: the only shuffles are today's
        # aggregation and today's side of the join (a plain state would add one)
        assert "Bucketed: true" in plans[-1]
        assert plans[-1].count("Exchange hashpartitioning") == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bits_count_distinct_days_in_window(spark):
    """P12∘P11: popcount of the 32-day integer = distinct active days in the
    32 days ending at as_of."""
    act = dl.daily_activity(si.web_events(spark, SF), "user_id")
    as_of = "2024-01-30"
    state = dl.datelist_backfill(act, key="user_id", as_of=as_of)
    bits = dl.datelist_int(state, key="user_id", as_of=as_of)
    got = {r["user_id"]: bin(r["datelist_int"]).count("1") for r in bits.collect()}
    window = act.where((F.col("date") > F.date_sub(F.to_date(F.lit(as_of)), 32))
                       & (F.col("date") <= F.to_date(F.lit(as_of))))
    want = {r["user_id"]: r["n"] for r in
            window.groupBy("user_id").agg(F.count_distinct("date").alias("n")).collect()}
    assert {k: v for k, v in got.items() if v} == want


def test_materialize_cuts_lineage(spark):
    from dimstack.plans.days import materialize
    from dimstack.plans.inspect import plan_text
    df = si.game_details(spark, SF).groupBy("game_id").count()
    m = materialize(df, "test")
    text = plan_text(m, "simple")
    assert "lineitem" not in text and "Exchange" not in text
    assert m.count() == df.count()


def test_batch_sessions_equal_session_window(spark):
    from dimstack.operators.patterns import sessions_batch
    from dimstack.streaming.jobs import sessions
    ev = si.web_events(spark, SF).select("ip", "host", F.col("event_time").alias("event_timestamp"))
    mine = sessions_batch(ev, ["ip", "host"], gap_seconds=1800)
    ref = sessions(ev.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")),
                   ["ip", "host"], gap="30 minutes").select(
        "ip", "host", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"), "num_events")
    cols = ["ip", "host", "session_start", "session_end", "num_events"]
    assert _rows(mine.select(*cols), cols) == _rows(ref.select(*cols), cols)
