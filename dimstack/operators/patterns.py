"""Analytical patterns (P26-P31): funnel, grouping-sets dashboards, rolling
windows, streaks.

Windows are used only after the data has been reduced to a bounded grain
(one row per entity per day or per game); raw events are first reduced with
group-bys, whose partial aggregation absorbs hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import channel
from ..plans.days import materialize
from ..plans.spread import HOT, partitions_for, split_hot
from ..schemas import ALL_LEVELS_LABEL, OVERALL, UNKNOWN


def funnel_conversion(events: DataFrame, *, target_url: str, min_n: int = 100) -> DataFrame:
    """Per url, the share of its page views followed the same day (by
    the same user) by a view of ``target_url``; only views that have some
    later event that day count, as in the reference's inner self join.

    Instead of the quadratic self join: one group-by per (user, day) gives
    the last event time and the last target time; joining them back decides
    each view (AQE splits a hot user-day on the large side)."""
    ev = (events.select("url", "host", "user_id", "event_time").distinct()
          .where(F.col("user_id").isNotNull())
          .withColumn("event_date", F.to_date("event_time")))
    per_day = ev.groupBy("user_id", "event_date").agg(
        F.max("event_time").alias("_last"),
        F.max(F.when(F.col("url") == target_url, F.col("event_time"))).alias("_last_target"))
    views = (ev.join(per_day, ["user_id", "event_date"])
             .where(F.col("_last") > F.col("event_time"))
             .groupBy("user_id", "event_time", "url")
             .agg(F.max(F.when(F.col("_last_target") > F.col("event_time"), 1).otherwise(0))
                  .alias("converted")))
    out = views.groupBy("url").agg(F.count(F.lit(1)).alias("n"),
                                   (F.sum("converted") / F.count(F.lit(1))).alias("conversion_rate"))
    return out.where((F.col("conversion_rate") > 0) & (F.col("n") > min_n))


def augment_with_devices(events: DataFrame, devices: DataFrame) -> DataFrame:
    """events ⋈ devices with NULL attributes shown as ``unknown`` (so they do
    not look like rolled-up columns)."""
    d = devices.select("device_id", *[F.coalesce(c, F.lit(UNKNOWN)).alias(c)
                                      for c in ("os_type", "device_type", "browser_type")])
    return events.join(d, "device_id")


def grouping_sets_dashboard(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Hits by (browser, device, os) and by each alone, with a level label."""
    aug = augment_with_devices(events, devices)
    cols = ["os_type", "device_type", "browser_type"]
    g = aug.groupingSets([["browser_type", "device_type", "os_type"], ["browser_type"],
                          ["os_type"], ["device_type"]], *cols).agg(
        F.count(F.lit(1)).alias("number_of_hits"),
        *[F.grouping(c).alias(f"_g_{c}") for c in cols])
    level = (F.when((F.col("_g_os_type") == 0) & (F.col("_g_device_type") == 0)
                    & (F.col("_g_browser_type") == 0), ALL_LEVELS_LABEL)
             .when(F.col("_g_browser_type") == 0, "browser_type")
             .when(F.col("_g_device_type") == 0, "device_type")
             .when(F.col("_g_os_type") == 0, "os_type"))
    return g.select(level.alias("aggregation_level"),
                    *[F.coalesce(c, F.lit(OVERALL)).alias(c) for c in cols], "number_of_hits")


GAME_SETS = {"player__team": ["player_name", "team"], "player__season": ["player_name", "season"], "team": ["team"]}


def _with_games(details: DataFrame, games: DataFrame) -> DataFrame:
    """Detail rows with their game's season and whether their team won it."""
    won = (((F.col("team_id") == F.col("home_team_id")) & (F.col("home_team_wins") == 1))
           | ((F.col("team_id") == F.col("visitor_team_id")) & (F.col("home_team_wins") == 0)))
    return details.join(games, "game_id").select(
        "player_name", "team", F.col("season").cast("string").alias("season"), "pts", "game_id",
        F.when(won, 1).otherwise(0).alias("won"))


def _sets_by_window(j: DataFrame) -> DataFrame:
    """Totals of the sets from rows that are dealt by game: the first row of a
    set in a game, a won one if there is one, counts the game."""
    keys = ["player_name", "team", "season"]
    for name, cols in GAME_SETS.items():
        first = F.row_number().over(Window.partitionBy("game_id", *cols).orderBy(F.desc("won"))) == 1
        j = j.withColumn(f"_n_{name}", F.when(first, 1).otherwise(0))
    sums = j.groupingSets(list(GAME_SETS.values()), *keys).agg(
        F.sum("pts").alias("total_pts"), F.grouping_id().alias("_gid"),
        *[F.sum(F.col(f"_n_{name}")).alias(f"n_{name}") for name in GAME_SETS],
        *[F.sum(F.col(f"_n_{name}") * F.col("won")).alias(f"w_{name}") for name in GAME_SETS])
    # grouping_id bits follow (player_name, team, season); 1 = rolled up
    of_set = {0b001: "player__team", 0b010: "player__season", 0b101: "team"}

    def pick(value):
        return F.coalesce(*[F.when(F.col("_gid") == gid, value(name)) for gid, name in of_set.items()])
    return sums.select(pick(F.lit).alias("aggregation_level"), *keys, "total_pts",
                       pick(lambda name: F.col(f"n_{name}")).alias("n_games"),
                       pick(lambda name: F.col(f"w_{name}")).alias("games_won"))


def _sets_by_grouping(j: DataFrame) -> DataFrame:
    """The same for games of any size.  Distinct games are counted in two
    hash-aggregate phases instead of with COUNT(DISTINCT) (which Spark expands
    once per distinct aggregate): the grouping sets first group per set *and
    game*, then each set's rows are counted."""
    keys = ["player_name", "team", "season", "game_id"]
    per_game = j.groupingSets([[*cols, "game_id"] for cols in GAME_SETS.values()], *keys).agg(
        F.sum("pts").alias("pts"), F.max("won").alias("won"), F.grouping_id().alias("_gid"))
    agg = per_game.groupBy("_gid", "player_name", "team", "season").agg(
        F.sum("pts").alias("total_pts"), F.count(F.lit(1)).alias("n_games"),
        F.sum("won").cast("bigint").alias("games_won"))
    # grouping_id bits follow (player_name, team, season, game_id); 1 = rolled up
    level = (F.when(F.col("_gid") == 0b0010, "player__team")
             .when(F.col("_gid") == 0b0100, "player__season")
             .otherwise("team"))
    return agg.select(level.alias("aggregation_level"), "player_name", "team", "season",
                      "total_pts", "n_games", "games_won")


def grouping_sets_games(details: DataFrame, games: DataFrame, hot: int = HOT) -> DataFrame:
    """Points and wins by (player, team), (player, season), (team).

    Details and games are dealt by game once, into partitions of a bounded
    number of rows; what crosses the network after that are the sets' sums.
    Games of more than ``hot`` detail rows are grouped per set and game."""
    g = games.select("game_id", "season", "home_team_id", "visitor_team_id", "home_team_wins")
    d = materialize(details.select("game_id", "player_name", F.col("team_abbreviation").alias("team"), "team_id", "pts"),
                    "games_details")
    light, heavy = split_hot(d, "game_id", hot)
    n = partitions_for(d)
    agg = _sets_by_window(_with_games(light.repartition(n, "game_id"), g.repartition(n, "game_id")))
    labels = ["player_name", "team", "season"]
    if heavy is not None:
        agg = (agg.unionByName(_sets_by_grouping(_with_games(heavy, g))).groupBy("aggregation_level", *labels)
               .agg(*[F.sum(c).alias(c) for c in ("total_pts", "n_games", "games_won")]))
    return agg.select("aggregation_level", *[F.coalesce(c, F.lit(OVERALL)).alias(c) for c in labels],
                      "total_pts", "n_games", "games_won")


def top_per_level(agg: DataFrame, *, level_col: str, metric: str,
                  label_cols: Sequence[str]) -> DataFrame:
    """The row with the largest ``metric`` per level (ties: the largest
    labels), via a max over a struct — a group-by, not a global sort."""
    best = agg.groupBy(level_col).agg(
        F.max(F.struct(F.col(metric), *[F.col(c) for c in label_cols])).alias("_b"))
    return best.select(level_col, *[F.col(f"_b.{c}").alias(c) for c in label_cols],
                       F.col(f"_b.{metric}").alias(metric))


def referrer_trend(events: DataFrame, devices: DataFrame, *, min_total: int = 500,
                   calendar: bool = False) -> DataFrame:
    """Per (referrer channel, url, day): count, rolling 7-row and
    previous-week sums, share of the month and of the total.

    ``calendar=False`` keeps the reference's row frames (6 preceding; 13..6
    preceding, Q13); ``calendar=True`` uses 7-day RANGE frames (0..6 and
    7..13 days back)."""
    aug = augment_with_devices(events, devices).select(
        "url", channel("referrer").alias("referrer"), F.to_date("event_time").alias("event_date"))
    daily = aug.groupBy("url", "referrer", "event_date").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("referrer", "url").orderBy("event_date")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    month = (Window.partitionBy("referrer", "url", F.trunc("event_date", "month"))
             .orderBy("event_date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    if calendar:
        by_day = Window.partitionBy("referrer", "url").orderBy(
            F.unix_date("event_date"))
        week, prev_week = by_day.rangeBetween(-6, 0), by_day.rangeBetween(-13, -7)
    else:
        week, prev_week = w.rowsBetween(-6, 0), w.rowsBetween(-13, -6)
    out = daily.select(
        "referrer", "url", "event_date", "count",
        F.sum("count").over(week).alias("weekly_rolling_count"),
        F.sum("count").over(prev_week).alias("previous_weekly_rolling_count"),
        (F.col("count") / F.sum("count").over(month)).alias("pct_of_month"),
        (F.col("count") / F.sum("count").over(whole)).alias("pct_of_total"),
        F.sum("count").over(whole).alias("_total"))
    return (out.where((F.col("_total") > min_total) & F.col("referrer").isNotNull())
            .drop("_total"))


def running_index(df: DataFrame, *, key: str | Sequence[str], order: Sequence[str],
                  flag: Column) -> DataFrame:
    """Position ``_idx`` (0-based) of each row within its ``key`` in the order
    ``order``, and ``_cum``, the running sum of ``flag`` through the row —
    without putting a key's rows into one task.

    The rows are range-partitioned by (key, order) and written once, so every
    partition holds about as many rows whatever the keys are; a small boundary
    table (one row per key and partition that holds some of it) carries the
    counts forward.  NULL keys are keys like any other."""
    from ..plans.days import materialize
    keys = [key] if isinstance(key, str) else list(key)
    ranged = (df.withColumn("_f", flag.cast("bigint")).repartitionByRange(*keys, *order)
              .withColumn("_b", F.spark_partition_id()))
    rows = materialize(ranged, "running_index")
    per_part = rows.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"),
                                             F.sum("_f").alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                              F.col("_b").alias("_b2"),
                              F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
                              F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"))
    same = F.col("_b") == F.col("_b2")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inner = Window.partitionBy(*keys, "_b").orderBy(*order)
    local = inner.rowsBetween(Window.unboundedPreceding, 0)
    return (rows.join(offsets, same)
            .withColumn("_idx", F.col("_n0") + F.row_number().over(inner) - 1)
            .withColumn("_cum", F.col("_s0") + F.sum("_f").over(local))
            .drop("_b", "_b2", "_n0", "_s0", "_f", *[f"_k{i}" for i in range(len(keys))]))


def sessions_batch(events: DataFrame, keys: Sequence[str], *, gap_seconds: int,
                   ts_col: str = "event_timestamp", materialize_index: bool = True) -> DataFrame:
    """P42 on a batch: sessions by ``keys`` with an inactivity gap, the same
    result as streaming ``session_window`` (a gap equal to ``gap_seconds``
    does not split; a session ends ``gap_seconds`` after its last event; NULL
    keys form sessions of their own).

    Skew-safe: events are numbered per key with ``running_index``, each event
    finds its predecessor by a null-safe equi-join on (key, index − 1),
    session starts are flagged by the gap, and a second running index numbers
    the sessions — no task holds a whole key.  The first index feeds both
    sides of the predecessor join; with ``materialize_index`` it is written
    once to the shared checkpoint folder."""
    keys = list(keys)
    ts = F.col(ts_col)
    base = events.select(*keys, ts_col).where(ts.isNotNull())
    idx = running_index(base, key=keys, order=[ts_col], flag=F.lit(0)).select(*keys, ts_col, "_idx")
    if materialize_index:
        from ..plans.days import materialize
        idx = materialize(idx, "session_index")
    prev = idx.select(*[F.col(k).alias(f"_p{i}") for i, k in enumerate(keys)],
                      (F.col("_idx") + 1).alias("_next"), F.col(ts_col).alias("_prev"))
    same = F.col("_idx") == F.col("_next")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_p{i}"))
    gap = F.timestamp_diff("MICROSECOND", F.col("_prev"), ts)
    marked = idx.join(prev, same, "left").select(
        *keys, ts_col, (F.col("_prev").isNull() | (gap > gap_seconds * 1_000_000)).alias("_start"))
    numbered = running_index(marked, key=keys, order=[ts_col], flag=F.col("_start"))
    return (numbered.groupBy(*keys, "_cum").agg(
        F.min(ts_col).alias("session_start"),
        (F.max(ts_col) + F.make_interval(secs=F.lit(gap_seconds))).alias("session_end"),
        F.count(F.lit(1)).alias("num_events"))
        .drop("_cum"))


def best_stretch(games: DataFrame, *, n: int = 90, materialize_index: bool = True) -> DataFrame:
    """Most wins of each team in any ``n`` consecutive games (by date,
    then id).  Home and away rows come from one scan (inline of a 2-element
    array).  Wins in the ``n`` games ending at row i are cum(i) − cum(i − n),
    the second found by an equi-join on (team, idx): no window spans a whole
    team (a few teams hold all games).  The index feeds both sides of that
    join; with ``materialize_index`` it is written once to the shared
    checkpoint folder."""
    rows = games.select(
        "game_id", "game_date_est",
        F.inline(F.array(
            F.struct(F.col("home_team_id").alias("team_id"),
                     F.col("home_team_wins").alias("won")),
            F.struct(F.col("visitor_team_id").alias("team_id"),
                     (1 - F.col("home_team_wins")).alias("won")))))
    idx = running_index(rows, key="team_id", order=["game_date_est", "game_id"],
                        flag=F.col("won")).select("team_id", "_idx", "_cum")
    if materialize_index:
        from ..plans.days import materialize
        idx = materialize(idx, "stretch_index")
    earlier = idx.select("team_id", (F.col("_idx") + n).alias("_idx"),
                         F.col("_cum").alias("_cum_before"))
    wins = idx.join(earlier, ["team_id", "_idx"], "left").select(
        "team_id", (F.col("_cum") - F.coalesce(F.col("_cum_before"), F.lit(0))).alias("_wins"))
    return wins.groupBy("team_id").agg(F.max("_wins").cast("bigint").alias("max_wins_in_stretch"))


def longest_streak(details: DataFrame, *, threshold: float = 10.0,
                   order_col: str = "game_id") -> DataFrame:
    """Per player the longest run of consecutive games (by
    ``order_col``, an integer id) with points over ``threshold``, and the
    number of runs.  Within a run, position − (qualifying games so far) is
    constant (gaps and islands), so runs are a group-by on that value."""
    over = F.col("pts") > threshold
    idx = running_index(details.select("player_id", order_col, "pts"), key="player_id",
                        order=[order_col], flag=F.coalesce(over, F.lit(False)))
    runs = (idx.where(over).groupBy("player_id", (F.col("_idx") - F.col("_cum")).alias("_island"))
            .agg(F.count(F.lit(1)).alias("_len")))
    return runs.groupBy("player_id").agg(F.max("_len").alias("longest_run"),
                                         F.count(F.lit(1)).alias("n_runs"))
