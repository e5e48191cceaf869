"""Property graph as two DataFrames: vertices and edges.

Vertex key (identifier, type); properties are a MAP<STRING, STRING>.

The player↔player edge table of the reference pairs every two players of a
game, which is quadratic in the size of a game.  It is not built here.  In its
place ``player_partner_totals`` gives, per player and edge type, the totals of
that pair table over all of the player's pairs (partner-games, own points,
partner points), computed from per-game and per-team group totals.  No pair is
ever formed, so a game holding a third of all rows costs linear work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.spread import HOT, partitions_for, split_hot
from .quality import first_per_key


def properties_map(cols: Sequence[str], names: Sequence[str] | None = None):
    names = names or cols
    kv = []
    for n, c in zip(names, cols):
        kv += [F.lit(n), F.col(c).cast("string")]
    return F.create_map(*kv)


def vertices(dim: DataFrame, *, id_col: str, vertex_type: str, prop_cols: Sequence[str],
             order_cols: Sequence[str], descending: bool = False) -> DataFrame:
    """Deduplicated dimension → (identifier, type, properties)."""
    one = first_per_key(dim.select(id_col, *prop_cols), [id_col], order_cols, descending)
    return one.select(F.col(id_col).alias("identifier"), F.lit(vertex_type).alias("type"),
                      properties_map(prop_cols).alias("properties"))


def player_game_edges(details: DataFrame, *, order_cols: Sequence[str],
                      prop_cols=("start_position", "pts", "team_id", "team_abbreviation"),
                      tie_break: bool = True) -> DataFrame:
    """One ``plays_in`` edge per (player, game)."""
    one = first_per_key(details, ["player_id", "game_id"], order_cols, tie_break=tie_break)
    return one.select(
        F.col("player_id").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("game_id").alias("object_identifier"), F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"), properties_map(list(prop_cols)).alias("properties"))


def _mates_by_window(base: DataFrame, n: int) -> DataFrame:
    """``base`` with the partners of each row on its own and on other teams and
    their points: one shuffle by game, into ``n`` partitions."""
    def over(*cols):
        w = Window.partitionBy("game_id", *cols)
        return F.count(F.lit(1)).over(w), F.sum("pts").over(w)
    levels = {"gtn": ["_team", "player_name"], "gt": ["_team"], "g": [], "gn": ["player_name"]}
    out = base.repartition(n, "game_id")
    for tag, cols in levels.items():
        count, points = over(*cols)
        out = out.withColumn(f"n_{tag}", count).withColumn(f"p_{tag}", points)
    out = out.where("_team IS NOT NULL AND player_name IS NOT NULL")
    return out.select("player_id", "player_name", "pts", *_mates())


def _mates():
    mates = F.col("n_gt") - F.col("n_gtn")
    mate_pts = F.col("p_gt") - F.col("p_gtn")
    return [mates.alias("_mates"), (F.col("n_g") - F.col("n_gn") - mates).alias("_opps"),
            mate_pts.alias("_mate_pts"), (F.col("p_g") - F.col("p_gn") - mate_pts).alias("_opp_pts")]


def _mates_by_join(base: DataFrame) -> DataFrame:
    """The same for games of any size, from grouped totals that are joined."""
    # the finest roster level once; the coarser ones are sums of it
    gtn = base.groupBy("game_id", "_team", "player_name").agg(
        F.count(F.lit(1)).alias("n_gtn"), F.sum("pts").alias("p_gtn"))

    def level(cols, tag):
        return gtn.groupBy(*cols).agg(F.sum("n_gtn").alias(f"n_{tag}"), F.sum("p_gtn").alias(f"p_{tag}"))

    roster = (gtn.join(level(["game_id"], "g"), "game_id")
              .join(level(["game_id", "_team"], "gt"), ["game_id", "_team"])
              .join(level(["game_id", "player_name"], "gn"), ["game_id", "player_name"])
              .select("game_id", "_team", "player_name", *_mates()))
    return base.join(roster, ["game_id", "_team", "player_name"]).select(
        "player_id", "player_name", "pts", "_mates", "_opps", "_mate_pts", "_opp_pts")


def player_partner_totals(details: DataFrame, *, order_cols: Sequence[str],
                          team_col: str = "team_abbreviation",
                          tie_break: bool = True, materialize_base: bool = True, hot: int = HOT) -> DataFrame:
    """P10 (re-aimed): per (player, edge_type) the sums over the player's
    pairs: ``partner_games`` (pairs × games), ``own_points``,
    ``partner_points``.  Partners share the game and have a different name;
    ``shares_team`` when the team is equal, else ``plays_against``.

    The deduplicated rows are read several times; with ``materialize_base`` they
    are written once to the shared checkpoint folder.  One shuffle by game then
    serves all four roster levels; games of more than ``hot`` rows go through
    partial sums and joins that split them."""
    from ..plans.days import materialize
    base = first_per_key(details, ["player_id", "game_id"], order_cols,
                         tie_break=tie_break).select(
        "game_id", "player_id", "player_name", F.col(team_col).alias("_team"), "pts")
    if materialize_base:
        base = materialize(base, "partner_base")

    light, heavy = split_hot(base, "game_id", hot)
    j = _mates_by_window(light, partitions_for(base))
    if heavy is not None:
        j = j.unionByName(_mates_by_join(heavy))
    mates, opps = F.col("_mates"), F.col("_opps")
    mate_pts, opp_pts = F.col("_mate_pts"), F.col("_opp_pts")
    per_row = j.select(
        "player_id", "player_name",
        F.inline(F.array(
            F.struct(F.lit("shares_team").alias("edge_type"), mates.alias("partners"),
                     (F.col("pts") * mates).alias("own"), mate_pts.alias("other")),
            F.struct(F.lit("plays_against").alias("edge_type"), opps.alias("partners"),
                     (F.col("pts") * opps).alias("own"), opp_pts.alias("other")))))
    return (per_row.where(F.col("partners") > 0)
            .groupBy("player_id", "player_name", "edge_type")
            .agg(F.sum("partners").alias("partner_games"), F.sum("own").alias("own_points"),
                 F.sum("other").alias("partner_points")))
