"""Plan shapes that matter at scale (read with explain, not guessed)."""

import uuid

from pyspark.sql import functions as F

from dimstack.operators import datelist as dl
from dimstack.operators.joins import bounded_broadcast
from dimstack.operators.patterns import funnel_conversion
from dimstack.operators.quality import first_per_key
from dimstack.plans.inspect import (count_exchanges, has_broadcast, plan_text, pushed_filters,
                                    read_schemas)
from dimstack.plans.layout import bucket_join_report, layout_report, match_join, written_layouts
from dimstack.session import checkpoint_path
from dimstack.sources.files import file_sizes, save_table
from dimstack.sources import standins as si
from dimstack.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def test_day_slice_reaches_the_scan(spark):
    today = dl.daily_activity(si.web_events(spark, SF), "user_id", start="2024-01-30",
                              end="2024-01-30")
    pf = " ".join(pushed_filters(today))
    assert "GreaterThanOrEqual(ts" in pf and "LessThan(ts" in pf


def test_column_pruning(spark):
    df = si.web_events(spark, SF).select("user_id", "event_time")
    schemas = read_schemas(df)
    assert schemas and "event_type" not in schemas[0] and "value" not in schemas[0]


def test_dedup_limits_before_the_shuffle(spark):
    d = first_per_key(si.game_details(spark, SF), ["player_id", "game_id"], ["line_no"])
    text = plan_text(d, "simple")
    assert "WindowGroupLimit" in text and "Partial" in text


def test_funnel_has_no_self_join_on_inequality(spark):
    text = plan_text(funnel_conversion(si.web_events(spark, SF), target_url="/purchase"), "simple")
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_bit_packing_needs_no_join(spark):
    state = dl.datelist_backfill(dl.daily_activity(si.web_events(spark, SF), "user_id"),
                                 key="user_id", as_of="2024-01-30")
    text = plan_text(dl.datelist_int(state, key="user_id", as_of="2024-01-30"), "simple")
    assert "Join" not in text
    assert count_exchanges(dl.datelist_int(state, key="user_id", as_of="2024-01-30")) == 1


def test_bounded_broadcast_checks_size(spark):
    nation = read_table(spark, SF, "nation")
    assert "broadcast" in plan_text(bounded_broadcast(nation, 100), "extended").lower()
    region = read_table(spark, SF, "region")
    assert has_broadcast(region.join(bounded_broadcast(nation, 100),
                                     region.r_regionkey == nation.n_regionkey))
    big = read_table(spark, SF, "lineitem")
    plain = bounded_broadcast(big, 100)
    assert "ResolvedHint" not in plan_text(plain, "extended")


def test_bucketed_join_skips_the_shuffle(spark):
    frames = [si.match_details(spark, SF), si.matches(spark, SF), si.medals_matches_players(spark, SF)]
    rows = bucket_join_report(spark, *frames, buckets=4).collect()
    by = {v: sorted(tuple(r)[1:] for r in rows if r["variant"] == v) for v in ("plain", "bucketed")}
    assert by["bucketed"] == by["plain"] != []
    tag = uuid.uuid4().hex[:8]
    tables = []
    for i, df in enumerate(frames):
        save_table(df, f"bj_{tag}_{i}", path=checkpoint_path(spark, "tests", f"bj_{tag}_{i}"),
                   bucket_col="match_id", buckets=4)
        tables.append(spark.table(f"bj_{tag}_{i}"))
    assert count_exchanges(match_join(*tables, "match_id")) == 0 < count_exchanges(match_join(*frames, "match_id"))


def test_layout_variants_hold_the_same_rows_in_fewer_files(spark):
    ev = si.web_events(spark, SF).select("event_id", "host", F.to_date("event_time").alias("event_date"))
    kinds = {"sorts": {"unsorted": [], "by_host": ["host"]}, "global_sorts": {"total": ["event_date"]}}
    rows = layout_report(spark, ev, partition_col="event_date", **kinds).collect()
    assert len({(r["n_rows"], r["n_values"], r["checksum"]) for r in rows}) == 1 and len(rows) == 3
    paths = written_layouts(spark, ev, partition_col="event_date", partitions=3, **kinds)
    assert {k: file_sizes(spark, p).first()["n_files"] for k, p in paths.items() if k != "total"} == \
        {"unsorted": 3, "by_host": 3}


def test_batch_plans_have_no_nested_loop_or_cartesian(spark):
    from queries import all_queries
    for name in ("experiment_readout", "experiment_exposures", "player_partner_totals", "monthly_hits",
                 "sessions_batch", "longest_streak", "funnel", "match_stats"):
        if name in all_queries():
            text = plan_text(all_queries()[name](spark, SF), "simple")
            assert "NestedLoop" not in text and "Cartesian" not in text, name
    readout = plan_text(all_queries()["experiment_readout"](spark, SF), "simple")
    assert readout.count("FileScan") == 1
    assert "Expand" not in plan_text(all_queries()["player_partner_totals"](spark, SF), "simple")
