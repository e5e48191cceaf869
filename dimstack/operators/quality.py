"""Data quality: grain checks and deduplication.

Deduplication keeps the first row per key under a total order, written as
``row_number() = 1``.  Spark plans this with a *partial* WindowGroupLimit
before the shuffle: every map task keeps only its first row per key, so a key
with millions of copies sends one row per task across the network, not all
of them to one reducer.  (A ``min(struct(...))`` group-by has the same
property but runs as a slower sort-based aggregate.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                  descending: bool = False, tie_break: bool = True) -> DataFrame:
    """One row per ``keys``: the smallest (or largest) by ``order_cols``, ties
    broken by the remaining columns, so the survivor is deterministic.  Pass
    ``tie_break=False`` when ``keys + order_cols`` is already unique (a
    shorter sort key)."""
    keys = list(keys)
    tie = [c for c in df.columns if c not in keys and c not in order_cols
           and _orderable(df, c)] if tie_break else []
    cols = [F.col(c) for c in [*order_cols, *tie]]
    if descending:
        cols = [c.desc_nulls_last() for c in cols]
    w = Window.partitionBy(*keys).orderBy(*cols)
    return (df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .drop("_rn"))


def _orderable(df: DataFrame, col: str) -> bool:
    from pyspark.sql import types as T
    t = df.schema[col].dataType
    return not isinstance(t, (T.MapType,))


def dedup_details(details: DataFrame, games: DataFrame, *,
                  keys: Sequence[str] = ("game_id", "team_id", "player_id"),
                  order_cols: Sequence[str] = ("line_no", "part_key")) -> DataFrame:
    """One detail row per (game, team, player), then the game's date.
    The reference orders the survivors by the game's date, which is constant
    within a game; deduplicating before the join keeps the partial
    WindowGroupLimit (the join would otherwise partition by game only)."""
    one = first_per_key(details, list(keys), list(order_cols))
    return one.join(games.select("game_id", "game_date_est"), "game_id")


def distinct_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """GROUP BY all (or ``keys``) without aggregates."""
    return df.dropDuplicates(list(keys)) if keys else df.distinct()


def grain_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def array_size_distribution(df: DataFrame, array_col: str) -> DataFrame:
    """CARDINALITY(array) → number of rows (P45 array-length check)."""
    return (df.groupBy(F.size(array_col).cast("bigint").alias("array_size"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def dedup_events(events: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | None = None,
                 drop_null_keys: Sequence[str] = ("user_id",)) -> DataFrame:
    """One event per ``keys`` (e.g. user and time, or url, host, user and
    time); with ``order_cols`` the survivor is the first by them."""
    df = events
    for k in drop_null_keys:
        df = df.where(F.col(k).isNotNull())
    if order_cols:
        return first_per_key(df, keys, order_cols)
    rest = [c for c in df.columns if c not in keys]
    return first_per_key(df, keys, rest) if rest else df.distinct()


def dedup_stream(events: DataFrame, keys: Sequence[str], event_time: str,
                 delay: str) -> DataFrame:
    """Streaming dedup bounded by the watermark (state is dropped once a key
    is older than the watermark)."""
    from ..streaming.jobs import dedup_within_watermark
    return dedup_within_watermark(events.withWatermark(event_time, delay), keys)
