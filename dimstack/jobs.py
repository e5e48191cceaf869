"""Runnable jobs: catalog table in, catalog table out (S04 + S11).

The same shape as the reference's three Spark jobs — a thin ``main`` around
a pure transformation — so they can be scheduled as they are:

    python -m dimstack.jobs player_scd     --source players --target players_scd
    python -m dimstack.jobs team_vertices  --source teams   --target vertices
    python -m dimstack.jobs monthly_hits   --source monthly_user_site_hits \\
                                           --target monthly_user_site_hits_agg --ds 2023-03-01
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .operators.graph import vertices
from .operators.reduced import first_days_totals
from .operators.scd import scd2_backfill
from .sources.files import insert_overwrite


def player_scd(players: DataFrame) -> DataFrame:
    """Streaks of scoring class per player (P05), reference column names."""
    return scd2_backfill(players, key="player_name", attrs=["scoring_class"],
                         period="current_season", start_col="start_date", end_col="end_date")


TEAM_PROPS = ["abbreviation", "nickname", "city", "arena", "year_founded"]


def team_vertices(teams: DataFrame) -> DataFrame:
    """One vertex per team (P08); the first row by nickname, descending."""
    return vertices(teams.withColumnRenamed("yearfounded", "year_founded"), id_col="team_id",
                    vertex_type="team", prop_cols=TEAM_PROPS, order_cols=["nickname"],
                    descending=True)


def monthly_hits(snapshot: DataFrame, ds: str) -> DataFrame:
    """Totals of the first three days per month of one partition."""
    return first_days_totals(snapshot, date_partition=ds, n=3)


JOBS = {
    "player_scd": lambda spark, a: player_scd(spark.table(a.source)),
    "team_vertices": lambda spark, a: team_vertices(spark.table(a.source)),
    "monthly_hits": lambda spark, a: monthly_hits(spark.table(a.source), a.ds),
}


def run(spark: SparkSession, job: str, source: str, target: str, ds: str | None = None) -> None:
    """Run one job: read ``source``, overwrite ``target`` (dynamic partitions)."""
    args = argparse.Namespace(source=source, target=target, ds=ds)
    insert_overwrite(JOBS[job](spark, args), target)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="python -m dimstack.jobs")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--source", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--ds")
    a = p.parse_args(argv)
    from .session import get_session
    run(get_session(f"dimstack-{a.job}"), a.job, a.source, a.target, a.ds)


if __name__ == "__main__":
    main()
