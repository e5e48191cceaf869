"""Registered queries: growth accounting and analytical patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimstack.operators import datelist as dl
from dimstack.operators import growth as gr
from dimstack.operators import patterns as pt
from dimstack.operators.quality import first_per_key
from dimstack.sources import standins as si

from .common import AS_OF, finalize
from .dimensional import players_state
from .facts import PREV_DAY

FUNNEL_TARGET = "/purchase"
FUNNEL_MIN_N = 100
TREND_MIN_TOTAL = 100
STRETCH = 90
STREAK_THRESHOLD = 10.0


def _activity(spark, sf_dir):
    return dl.daily_activity(si.web_events(spark, sf_dir), "user_id", end=AS_OF)


def _flat_growth(df):
    return finalize(df.select("user_id", "date", "first_active_date", "last_active_date",
                              "daily_active_state", "weekly_active_state",
                              F.size("dates_active").cast("bigint").alias("n_dates"),
                              F.array_join(F.col("dates_active").cast("array<string>"), ",").alias("dates")))


def q_growth_accounting(spark, sf_dir):
    return _flat_growth(gr.growth_backfill(_activity(spark, sf_dir), as_of=AS_OF))


def q_growth_accounting_step(spark, sf_dir):
    act = _activity(spark, sf_dir)
    prev = gr.growth_backfill(act, as_of=PREV_DAY).where(F.col("date") == F.to_date(F.lit(PREV_DAY)))
    today = act.where(F.col("date") == F.to_date(F.lit(AS_OF)))
    return _flat_growth(gr.growth_step(prev, today, today_date=AS_OF))


def q_season_state_changes(spark, sf_dir):
    return finalize(gr.season_state_changes(players_state(spark, sf_dir), key="player_id"))


def q_retention(spark, sf_dir):
    return finalize(gr.retention(gr.growth_backfill(_activity(spark, sf_dir), as_of=AS_OF)))


def q_funnel_conversion(spark, sf_dir):
    return finalize(pt.funnel_conversion(si.web_events(spark, sf_dir), target_url=FUNNEL_TARGET,
                                         min_n=FUNNEL_MIN_N))


def q_grouping_sets_dashboard(spark, sf_dir):
    return finalize(pt.grouping_sets_dashboard(si.web_events(spark, sf_dir),
                                               si.devices(spark, sf_dir)))


def _details_dedup(spark, sf_dir):
    return first_per_key(si.game_details(spark, sf_dir), ["player_id", "game_id"],
                         ["line_no", "part_key"])


def _games_sets(spark, sf_dir):
    return pt.grouping_sets_games(_details_dedup(spark, sf_dir), si.games(spark, sf_dir))


def q_grouping_sets_games(spark, sf_dir):
    return finalize(_games_sets(spark, sf_dir))


def q_grouping_sets_games_top(spark, sf_dir):
    return finalize(pt.top_per_level(_games_sets(spark, sf_dir), level_col="aggregation_level",
                                     metric="total_pts",
                                     label_cols=["player_name", "team", "season"]))


def q_referrer_trend(spark, sf_dir):
    return finalize(pt.referrer_trend(si.web_events(spark, sf_dir), si.devices(spark, sf_dir),
                                      min_total=TREND_MIN_TOTAL))


def q_referrer_trend_calendar(spark, sf_dir):
    return finalize(pt.referrer_trend(si.web_events(spark, sf_dir), si.devices(spark, sf_dir),
                                      min_total=TREND_MIN_TOTAL, calendar=True))


def q_best_stretch(spark, sf_dir):
    return finalize(pt.best_stretch(si.games(spark, sf_dir), n=STRETCH))


def q_longest_streak(spark, sf_dir):
    return finalize(pt.longest_streak(_details_dedup(spark, sf_dir), threshold=STREAK_THRESHOLD))


QUERIES = {
    "growth_accounting": q_growth_accounting,
    "growth_accounting_step": q_growth_accounting_step,
    "season_state_changes": q_season_state_changes,
    "retention": q_retention,
    "funnel_conversion": q_funnel_conversion,
    "grouping_sets_dashboard": q_grouping_sets_dashboard,
    "grouping_sets_games": q_grouping_sets_games,
    "grouping_sets_games_top": q_grouping_sets_games_top,
    "referrer_trend": q_referrer_trend,
    "referrer_trend_calendar": q_referrer_trend_calendar,
    "best_stretch": q_best_stretch,
    "longest_streak": q_longest_streak,
}
