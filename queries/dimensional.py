"""Registered queries: cumulative tables, SCD2, graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimstack.functions.arrays import first_element, last_element
from dimstack.operators import cumulative as cum
from dimstack.operators import graph, scd
from dimstack.sources import standins as si

from .common import FIRST_SEASON, LAST_SEASON, STEP_SEASON, finalize

BOUNDED_LAST = 1998     # before the last season of the data
SEASON_FIELDS = ["season", "gp", "pts", "reb", "ast"]
STATIC = ["player_name", "country"]


def players_state(spark, sf_dir, last=LAST_SEASON, rows=None):
    rows = rows if rows is not None else si.entity_seasons(spark, sf_dir)
    return cum.cumulative_backfill(rows, key="player_id", period="season", static_cols=STATIC,
                                   struct_cols=SEASON_FIELDS, last_period=last)


def _flat_players(state):
    last = last_element(F.col("seasons"))
    return finalize(state.select(
        "player_id", "player_name", "country", "current_season",
        F.size("seasons").cast("bigint").alias("n_seasons"),
        first_element(F.col("seasons"))["season"].alias("first_season"),
        last["season"].alias("last_season"), last["pts"].alias("last_pts"),
        F.array_join(F.transform("seasons", lambda s: F.concat_ws(":", s["season"].cast("string"),
                                                                  s["gp"].cast("string"))), ",").alias("season_list"),
        "scoring_class", "periods_since_last_active", "is_active"))


def q_cumulative_backfill_bounded(spark, sf_dir):
    """Some players start after the last period: they have no rows."""
    return _flat_players(players_state(spark, sf_dir, last=BOUNDED_LAST))


def q_cumulative_backfill(spark, sf_dir):
    return _flat_players(players_state(spark, sf_dir))


def q_cumulative_step(spark, sf_dir):
    rows = si.entity_seasons(spark, sf_dir)
    prev = players_state(spark, sf_dir, last=STEP_SEASON - 1,
                         rows=rows.where(F.col("season") <= STEP_SEASON - 1)
                         ).where(F.col("current_season") == STEP_SEASON - 1)
    today = rows.where(F.col("season") == STEP_SEASON)
    state = cum.cumulative_step(prev, today, key="player_id", period="season",
                                static_cols=STATIC, struct_cols=SEASON_FIELDS,
                                current=STEP_SEASON)
    return _flat_players(state)


def q_cumulative_multi(spark, sf_dir):
    films = si.entity_films(spark, sf_dir)
    state = cum.cumulative_backfill_multi(
        films, key="actorid", period="year", static_cols=["actor"], rating_col="rating",
        sum_cols=["votes"], last_period=LAST_SEASON)
    years = F.col("years")
    return finalize(state.select(
        "actorid", "actor", "current_year",
        F.aggregate(years, F.lit(0).cast("bigint"), lambda a, y: a + y["n_items"]).alias("n_films"),
        F.aggregate(years, F.lit(0).cast("bigint"), lambda a, y: a + y["sum_votes"])
        .alias("total_votes"),
        last_element(years)["avg_rating"].alias("latest_avg_rating"),
        F.array_join(F.transform(years, lambda y: F.concat_ws(":", y["year"].cast("string"),
                                                              y["n_items"].cast("string"))), ",").alias("year_list"),
        "quality_class", "periods_since_last_active", "is_active"))


def q_history_unnest(spark, sf_dir):
    state = players_state(spark, sf_dir).where(F.col("current_season") == LAST_SEASON)
    return finalize(cum.history_unnest(state, key="player_id"))


def q_history_ratio(spark, sf_dir):
    state = players_state(spark, sf_dir).where(F.col("current_season") == LAST_SEASON)
    return finalize(cum.history_ratio(state, key="player_id"))


def q_scd2_backfill(spark, sf_dir):
    state = players_state(spark, sf_dir)
    return finalize(scd.scd2_backfill(state, key="player_id", attrs=["scoring_class"],
                                      period="current_season"))


def _scd_multi(state, as_of):
    return scd.scd2_backfill(state, key="player_id", attrs=["scoring_class", "is_active"],
                             period="current_season", as_of=as_of,
                             current_col="current_period")


def q_scd2_backfill_multi(spark, sf_dir):
    return finalize(_scd_multi(players_state(spark, sf_dir), LAST_SEASON))


def q_scd2_incremental(spark, sf_dir):
    state = players_state(spark, sf_dir)
    prev = _scd_multi(state, STEP_SEASON - 1)
    snap = state.where(F.col("current_season") == STEP_SEASON)
    out = scd.scd2_incremental(prev, snap, key="player_id", attrs=["scoring_class", "is_active"],
                               prev=STEP_SEASON - 1, cur=STEP_SEASON)
    return finalize(out)


def q_scd2_incremental_rerun(spark, sf_dir):
    """The same step run again over its own result."""
    state = players_state(spark, sf_dir)
    snap = state.where(F.col("current_season") == STEP_SEASON)
    args = {"key": "player_id", "attrs": ["scoring_class", "is_active"], "prev": STEP_SEASON - 1, "cur": STEP_SEASON}
    once = scd.scd2_incremental(_scd_multi(state, STEP_SEASON - 1), snap, **args)
    return finalize(scd.scd2_incremental(once, snap, **args))


TEAM_PROPS = ["abbreviation", "nickname", "city", "arena", "year_founded"]


def q_team_vertices(spark, sf_dir):
    t = si.teams(spark, sf_dir).withColumnRenamed("yearfounded", "year_founded")
    v = graph.vertices(t, id_col="team_id", vertex_type="team", prop_cols=TEAM_PROPS,
                       order_cols=TEAM_PROPS)
    return finalize(v.select("identifier", "type",
                             *[F.col("properties")[p].alias(p) for p in TEAM_PROPS]))


EDGE_PROPS = ["start_position", "pts", "team_id", "team_abbreviation"]


def q_player_game_edges(spark, sf_dir):
    e = graph.player_game_edges(si.game_details(spark, sf_dir), order_cols=["line_no", "part_key"])
    return finalize(e.select("subject_identifier", "subject_type", "object_identifier",
                             "object_type", "edge_type",
                             *[F.col("properties")[p].alias(p) for p in EDGE_PROPS]))


def q_player_partner_totals(spark, sf_dir):
    return finalize(graph.player_partner_totals(si.game_details(spark, sf_dir),
                                                order_cols=["line_no", "part_key"]))


QUERIES = {
    "cumulative_backfill": q_cumulative_backfill,
    "cumulative_backfill_bounded": q_cumulative_backfill_bounded,
    "cumulative_step": q_cumulative_step,
    "cumulative_multi": q_cumulative_multi,
    "history_unnest": q_history_unnest,
    "history_ratio": q_history_ratio,
    "scd2_backfill": q_scd2_backfill,
    "scd2_backfill_multi": q_scd2_backfill_multi,
    "scd2_incremental": q_scd2_incremental,
    "scd2_incremental_rerun": q_scd2_incremental_rerun,
    "team_vertices": q_team_vertices,
    "player_game_edges": q_player_game_edges,
    "player_partner_totals": q_player_partner_totals,
}
