"""Growth accounting, season state changes, retention.

``growth_backfill`` is the closed form of running ``growth_step`` day after
day: per user the distinct active days (one group-by; at most one entry per
day), then one row per (user, day) from the first active day to ``as_of``,
with the previous active day found in the user's own array.  No window, no
chain of 30 full outer joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import append_if
from ..functions.scalar import days_between
from .joins import full_outer_on_key


def _d(value) -> Column:
    return value if isinstance(value, Column) else F.to_date(F.lit(value))


def _states(has_prev: Column, active: Column, day: Column, prev_last: Column,
            prev_date: Column):
    """Daily and weekly state, first matching rule wins (comparisons with an
    absent today are NULL and fall through, as in SQL)."""
    today = F.when(active, day)
    daily = (F.when(~has_prev, "New")
             .when(prev_last == F.date_sub(today, 1), "Retained")
             .when(prev_last < F.date_sub(today, 1), "Resurrected")
             .when(today.isNull() & (prev_last == prev_date), "Churned")
             .otherwise("Stale"))
    weekly = (F.when(~has_prev, "New")
              .when(prev_last < F.date_sub(today, 7), "Resurrected")
              .when(today.isNull() & (prev_last == F.date_sub(prev_date, 7)), "Churned")
              .when(F.date_add(F.coalesce(today, prev_last), 7) >= prev_date, "Retained")
              .otherwise("Stale"))
    return daily, weekly


def growth_step(prev: DataFrame, today: DataFrame, *, today_date) -> DataFrame:
    """P23 step: ``prev`` (users_growth_accounting at today − 1) ⟗ today's
    active users (user_id, date)."""
    t = today.select("user_id", F.col("date").alias("today_date"))
    j = full_outer_on_key(prev, t, "user_id")
    has_prev = F.col("y.user_id").isNotNull()
    active = F.col("t.user_id").isNotNull()
    daily, weekly = _states(has_prev, active, _d(today_date), F.col("y.last_active_date"),
                            F.col("y.date"))
    return j.select(
        F.coalesce(F.col("t.user_id"), F.col("y.user_id")).alias("user_id"),
        F.coalesce(F.col("y.first_active_date"), F.col("t.today_date")).alias("first_active_date"),
        F.coalesce(F.col("t.today_date"), F.col("y.last_active_date")).alias("last_active_date"),
        daily.alias("daily_active_state"), weekly.alias("weekly_active_state"),
        append_if(F.col("y.dates_active"), active, F.col("t.today_date"), "date")
        .alias("dates_active"),
        F.coalesce(F.col("t.today_date"), F.date_add(F.col("y.date"), 1)).alias("date"))


def growth_backfill(activity: DataFrame, *, as_of, start=None) -> DataFrame:
    """Every (user, day) snapshot from the user's first active day (or
    ``start``) through ``as_of``."""
    a = activity.where(F.col("date") <= _d(as_of))
    per_user = a.groupBy("user_id").agg(F.array_sort(F.collect_set("date")).alias("_all"))
    first = F.col("_all")[0]
    grid = per_user.select(
        "user_id", "_all", first.alias("first_active_date"),
        F.explode(F.sequence(first if start is None else F.greatest(first, _d(start)),
                             _d(as_of), F.expr("INTERVAL 1 DAY"))).alias("date"))
    d = F.col("date")
    active = F.array_contains("_all", d)
    prev_last = F.array_max(F.filter("_all", lambda x: x < d))
    has_prev = d > F.col("first_active_date")
    daily, weekly = _states(has_prev, active, d, prev_last, F.date_sub(d, 1))
    return grid.select(
        "user_id", "first_active_date",
        F.when(active, d).otherwise(prev_last).alias("last_active_date"),
        daily.alias("daily_active_state"), weekly.alias("weekly_active_state"),
        F.filter("_all", lambda x: x <= d).alias("dates_active"), "date")


def season_state_changes(state: DataFrame, *, key: str, period: str = "current_season",
                         history_col: str = "seasons", field: str = "season") -> DataFrame:
    """New / Continued Playing / Retired / Returned from Retirement /
    Stayed Retired, from the cumulative snapshots (previous period's activity
    is read from the history array, so no window is needed)."""
    p = F.col(period)
    active = F.exists(history_col, lambda s: s[field] == p)
    was_active = F.exists(history_col, lambda s: s[field] == p - 1)
    first = F.col(history_col)[0][field] == p
    st = (F.when(first, "New")
          .when(active & was_active, "Continued Playing")
          .when(~active & was_active, "Retired")
          .when(active & ~was_active, "Returned from Retirement")
          .otherwise("Stayed Retired"))
    return state.select(key, period, st.alias("season_state"))


def retention(growth: DataFrame,
              active_states=("Retained", "Resurrected", "New")) -> DataFrame:
    """P25: share of (user, day) rows in an active state by days since the
    user's first active day."""
    days = days_between(F.col("date"), F.col("first_active_date"))
    return growth.groupBy(days.alias("days_since_first_active")).agg(
        (F.count(F.when(F.col("daily_active_state").isin(list(active_states)), 1))
         / F.count(F.lit(1))).alias("pct_active"),
        F.count(F.lit(1)).alias("n_rows"))
