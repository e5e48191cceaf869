"""Cumulative tables.

State is a snapshot per period: one row per (key, period) holding the key's
static attributes, the array-of-struct history so far, a class from the
latest struct, ``is_active`` and ``periods_since_last_active``.

Scale notes
* The backfill makes ONE shuffle: a group-by on the key that collects the
  key's per-period structs (bounded by the number of periods: the input grain
  is one row per (key, period); P03 first reduces its many rows per
  (key, period) to one).  Snapshots are generated with ``explode(sequence)``
  and ``filter(history, s -> s.period <= p)``: no non-equi join to a period
  series, no window.
* The step is one full outer join on the key (null keys dropped first).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import empty_array, last_element
from ..functions.scalar import quality_class, scoring_class
from .joins import full_outer_on_key


def _struct(cols: Sequence[str], prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in cols])


def cumulative_step(prev: DataFrame, today: DataFrame, *, key: str, period: str,
                    static_cols: Sequence[str], struct_cols: Sequence[str],
                    class_of: Callable[[Column], Column] = scoring_class,
                    class_field: str = "pts", class_col: str = "scoring_class",
                    history_col: str = "seasons", current: int,
                    state_period: str = "current_season") -> DataFrame:
    """yesterday's state ⟗ today's rows → today's state.

    ``prev`` has ``key, static_cols, history_col, class_col, is_active,
    periods_since_last_active, state_period``; ``today`` has ``key,
    static_cols, struct_cols`` for the period ``current``.
    """
    y_cols = [key, *static_cols, history_col, class_col, "periods_since_last_active"]
    t_cols = [key, *static_cols, *struct_cols]
    j = full_outer_on_key(prev.select(*y_cols), today.select(*t_cols), key)
    active = F.col(f"t.{key}").isNotNull()
    elem_type = today.select(_struct(struct_cols)).schema[0].dataType.simpleString()
    history = F.coalesce(F.col(f"y.{history_col}"), empty_array(elem_type))
    today_struct = _struct(struct_cols, "t.")
    return j.select(
        F.coalesce(F.col(f"y.{key}"), F.col(f"t.{key}")).alias(key),
        *[F.coalesce(F.col(f"y.{c}"), F.col(f"t.{c}")).alias(c) for c in static_cols],
        F.when(active, F.concat(history, F.array(today_struct))).otherwise(history)
        .alias(history_col),
        F.when(active, class_of(F.col(f"t.{class_field}")))
        .otherwise(F.col(f"y.{class_col}")).alias(class_col),
        F.when(active, F.lit(0).cast("bigint"))
        .otherwise(F.col("y.periods_since_last_active") + 1).alias("periods_since_last_active"),
        active.alias("is_active"),
        F.lit(current).alias(state_period),
    )


def cumulative_backfill(rows: DataFrame, *, key: str, period: str,
                        static_cols: Sequence[str], struct_cols: Sequence[str],
                        last_period: int,
                        class_of: Callable[[Column], Column] = scoring_class,
                        class_field: str = "pts", class_col: str = "scoring_class",
                        history_col: str = "seasons",
                        state_period: str = "current_season") -> DataFrame:
    """One row per (key, period) from the key's first period through
    ``last_period``; history = structs of periods <= that period.  Rows after
    ``last_period`` (or without a period) take no part; a key that has no
    others has no rows.

    ``period`` must be one of ``struct_cols``.  Static columns are the MAX per
    key, as in the reference backfill.
    """
    per_key = rows.where(F.col(period) <= last_period).groupBy(key).agg(
        F.min(period).alias("_first"),
        *[F.max(c).alias(c) for c in static_cols],
        F.array_sort(F.collect_list(_struct(struct_cols))).alias("_all"),
    )
    # array_sort orders structs field by field; put the period first
    if struct_cols[0] != period:
        raise ValueError("the period must be the first struct field")
    snap = per_key.select(
        key, *static_cols, "_all",
        F.explode(F.sequence(F.col("_first").cast("int"), F.lit(last_period))).alias(state_period))
    hist = F.filter(F.col("_all"), lambda s: s[period] <= F.col(state_period))
    last = last_element(F.col(history_col))
    return (snap.withColumn(history_col, hist)
            .select(key, *static_cols, history_col,
                    class_of(last[class_field]).alias(class_col),
                    (F.col(state_period) - last[period]).cast("bigint")
                    .alias("periods_since_last_active"),
                    (last[period] == F.col(state_period)).alias("is_active"),
                    state_period))


def cumulative_backfill_multi(rows: DataFrame, *, key: str, period: str,
                              static_cols: Sequence[str], rating_col: str, last_period: int,
                              sum_cols: Sequence[str] = (),
                              class_of: Callable[[Column], Column] = quality_class,
                              class_col: str = "quality_class",
                              history_col: str = "years",
                              state_period: str = "current_year") -> DataFrame:
    """Many rows per (key, period) (films per actor and year).

    The history holds one summary struct per active period — ``period``,
    ``n_items``, ``avg_<rating_col>`` and ``sum_<c>`` for ``sum_cols`` — not
    every item: a prolific key would otherwise pile all its rows into one
    record (the items stay in the fact table).  The class comes from the
    latest period's average rating (the homework's rule, Q21)."""
    per_period = rows.where(F.col(period) <= last_period).groupBy(key, period).agg(
        *[F.max(c).alias(c) for c in static_cols],
        F.count(F.lit(1)).alias("n_items"),
        F.avg(rating_col).alias(f"avg_{rating_col}"),
        *[F.sum(c).alias(f"sum_{c}") for c in sum_cols])
    fields = [period, "n_items", f"avg_{rating_col}", *[f"sum_{c}" for c in sum_cols]]
    per_key = per_period.groupBy(key).agg(
        F.min(period).alias("_first"),
        *[F.max(c).alias(c) for c in static_cols],
        F.array_sort(F.collect_list(F.struct(*fields))).alias("_all"))
    snap = per_key.select(
        key, *static_cols, "_all",
        F.explode(F.sequence(F.col("_first").cast("int"), F.lit(last_period))).alias(state_period))
    hist = F.filter(F.col("_all"), lambda s: s[period] <= F.col(state_period))
    last = last_element(F.col(history_col))
    return (snap.withColumn(history_col, hist)
            .select(key, *static_cols, history_col,
                    class_of(last[f"avg_{rating_col}"]).alias(class_col),
                    (F.col(state_period) - last[period]).cast("bigint")
                    .alias("periods_since_last_active"),
                    (last[period] == F.col(state_period)).alias("is_active"),
                    state_period))


def history_unnest(state: DataFrame, *, key: str, history_col: str = "seasons") -> DataFrame:
    """Array of structs → one row per element (UNNEST / inline)."""
    return state.select(key, F.inline(history_col))


def history_ratio(state: DataFrame, *, key: str, field: str = "pts",
                  history_col: str = "seasons") -> DataFrame:
    """Last element's ``field`` / first element's ``field`` (1 when 0)."""
    first = F.try_element_at(F.col(history_col), F.lit(1))[field]
    last = last_element(F.col(history_col))[field]
    den = F.when(first == 0, F.lit(1.0)).otherwise(first)
    return state.select(key, (last / den).alias("ratio_most_recent_to_first"))
