"""Registered queries: experiments (P43-P44) and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimstack.operators import datelist as dl
from dimstack.operators import experiments as ex
from dimstack.operators import quality as qa
from dimstack.sources import standins as si

from .common import AS_OF, finalize

EXPERIMENT = "exp1"
TARGET = "/purchase"


def _assignments(spark, sf_dir):
    return ex.assign(si.web_events(spark, sf_dir).where(F.col("user_id").isNotNull()),
                     experiment=EXPERIMENT)


def q_experiment_assignment(spark, sf_dir):
    return finalize(_assignments(spark, sf_dir))


def q_experiment_exposures(spark, sf_dir):
    return finalize(ex.exposures(si.web_events(spark, sf_dir), experiment=EXPERIMENT))


def q_experiment_readout(spark, sf_dir):
    return finalize(ex.readout(si.web_events(spark, sf_dir), experiment=EXPERIMENT,
                               target_url=TARGET))


def q_experiment_lagging(spark, sf_dir):
    return finalize(ex.lagging_difference(si.web_events(spark, sf_dir), experiment=EXPERIMENT))


def q_grain_check(spark, sf_dir):
    return finalize(qa.grain_violations(si.game_details(spark, sf_dir), ["game_id", "player_id"]))


def q_array_size_check(spark, sf_dir):
    state = dl.datelist_backfill(dl.daily_activity(si.web_events(spark, sf_dir), "user_id"),
                                 key="user_id", as_of=AS_OF)
    return finalize(qa.array_size_distribution(state, "dates_active"))


def q_dedup_game_details(spark, sf_dir):
    out = qa.dedup_details(si.game_details(spark, sf_dir), si.games(spark, sf_dir))
    return finalize(out.select("game_id", "team_id", "player_id", "player_name", "pts",
                               "game_date_est", "line_no"))


def q_dedup_events(spark, sf_dir):
    out = qa.dedup_events(si.web_events(spark, sf_dir), ["user_id", "event_time"], ["event_id"])
    return finalize(out.select("user_id", "event_time", "event_id", "url", "host"))


def q_dedup_events_full(spark, sf_dir):
    out = qa.dedup_events(si.web_events(spark, sf_dir), ["url", "host", "user_id", "event_time"],
                          ["event_id"])
    return finalize(out.select("user_id", "event_time", "event_id", "url", "host"))


QUERIES = {
    "experiment_assignment": q_experiment_assignment,
    "experiment_exposures": q_experiment_exposures,
    "experiment_readout": q_experiment_readout,
    "experiment_lagging": q_experiment_lagging,
    "grain_check": q_grain_check,
    "array_size_check": q_array_size_check,
    "dedup_game_details": q_dedup_game_details,
    "dedup_events": q_dedup_events,
    "dedup_events_full": q_dedup_events_full,
}
