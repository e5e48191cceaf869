"""Strongest partners of a player without a pair table (P10).

A player is the set of their games.  Two players with at least ``min_shared``
games in common share one that is not among the ``min_shared - 1`` most crowded
games of either (prefix filtering: rare games first).  So pairs are formed in
the less crowded games only; the crowded ones, which would pair everybody with
everybody, are looked up for the pairs that were found.  A look-up costs a row
for each partner of a player, so games of at most SMALL players, which cost less
as pairs, never count as crowded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.spread import partitions_for, split_hot
from .quality import first_per_key

#: Players up to which a game is always expanded into its pairs.
SMALL = 32


def crowded_games(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` most crowded games of each player (ties: larger id).  The rank
    limit runs before the shuffle, so a task passes on n rows of a player."""
    crowd = rows.groupBy("game_id").agg(F.count(F.lit(1)).alias("crowd"))
    order = Window.partitionBy("player_id").orderBy(F.desc("crowd"), F.desc("game_id"))
    return (rows.join(crowd, "game_id").withColumn("_rank", F.row_number().over(order))
            .where(F.col("_rank") <= n).select("player_id", "game_id", "pts"))


def strongest_partners(details: DataFrame, *, min_shared: int, order_cols: Sequence[str] = ("line_no",),
                       tie_break: bool = True, small: int = SMALL) -> DataFrame:
    """``(player_id, partner_id, shared_games, own_points, partner_points)`` for
    every two players with at least ``min_shared`` (two or more) games in common,
    in both directions; exact counts and points over all shared games.

    Repeated lines of a player in a game count once (first by ``order_cols``).
    Players with fewer games than the bound have no partner.  Rows without a
    player or game match nothing.  A game of more than ``small`` players is expanded
    into pairs only as far as ``min_shared`` still more crowded games of its players
    do not push it out.
    """
    from ..plans.days import materialize
    if min_shared < 2:
        raise ValueError("a bound below two would pair all players of every game")
    one = first_per_key(details.where("player_id IS NOT NULL AND game_id IS NOT NULL"),
                        ["player_id", "game_id"], list(order_cols), tie_break=tie_break)
    rows = materialize(one.select("player_id", "game_id", F.coalesce("pts", F.lit(0)).alias("pts")), "partner_rows")
    enough = materialize(rows.groupBy("player_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_shared)
                         .select("player_id"), "partner_enough")
    rows = rows.join(enough, "player_id")
    light, heavy = split_hot(rows, "game_id", small)
    n = partitions_for(rows)

    def as_(df, who, *more):
        return df.select(F.col("player_id").alias(who), "game_id", F.col("pts").alias(f"pts_{who}"),
                         *[F.col(c).alias(f"{c}_{who}") for c in more])

    def pairs(df, *more):
        return as_(df, "a", *more).join(as_(df, "b", *more), "game_id").where("a < b")
    pair = ["a", "b"]
    sums = [F.count(F.lit(1)).alias("n"), F.sum("pts_a").alias("pts_a"), F.sum("pts_b").alias("pts_b")]
    if heavy is None:
        total = pairs(light.repartition(n, "game_id")).groupBy(*pair).agg(*sums).withColumnRenamed("n", "shared_games")
    else:
        crowded = materialize(crowded_games(heavy, min_shared - 1), "partner_crowded")
        # open: games of the player that no pair is formed in
        opened = crowded.groupBy("player_id").agg(F.count(F.lit(1)).alias("open"))
        opened = materialize(opened, "partner_open")

        def marked(df):
            return df.join(opened, "player_id", "left").withColumn("open", F.coalesce("open", F.lit(0)))
        rest = marked(heavy.join(crowded.select("player_id", "game_id"), ["player_id", "game_id"], "left_anti"))
        # what the open games can add decides which pairs are still possible
        met = (pairs(marked(light).repartition(n, "game_id"), "open").unionByName(pairs(rest, "open")).groupBy(*pair)
               .agg(*sums, F.max(F.col("open_a") + F.col("open_b")).alias("open"))
               .where(F.col("n") + F.col("open") >= min_shared).drop("open"))
        met = materialize(met, "partner_met")
        # a game that is crowded for one of the two: at most min_shared - 1 lookups for each
        mine = met.select(*pair).join(as_(crowded, "a"), "a").join(as_(heavy, "b"), ["b", "game_id"])
        theirs = met.select(*pair).join(as_(crowded, "b"), "b").join(as_(heavy, "a"), ["a", "game_id"])
        cols = [*pair, "game_id", "pts_a", "pts_b"]
        looked_up = mine.select(*cols).unionByName(theirs.select(*cols)).dropDuplicates([*pair, "game_id"])
        total = (met.unionByName(looked_up.groupBy(*pair).agg(*sums)).groupBy(*pair)
                 .agg(F.sum("n").alias("shared_games"), F.sum("pts_a").alias("pts_a"), F.sum("pts_b").alias("pts_b")))
    total = total.where(F.col("shared_games") >= min_shared)
    both = F.array(F.struct(F.col("a").alias("player_id"), F.col("b").alias("partner_id"), "shared_games",
                            F.col("pts_a").alias("own_points"), F.col("pts_b").alias("partner_points")),
                   F.struct(F.col("b").alias("player_id"), F.col("a").alias("partner_id"), "shared_games",
                            F.col("pts_b").alias("own_points"), F.col("pts_a").alias("partner_points")))
    return total.select(F.inline(both))
