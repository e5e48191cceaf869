"""Reduced facts: one row per (key, month) with a per-day metric array
(P18-P22).

Positions are derived from the date (day offset in the month), so a step is
idempotent: re-running day d slices the stored array to d's offset before
appending (the reference appends again, Q15).  Upserts rewrite the rows of
the touched month: ``existing ⟕anti updates ∪ updates``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import safe_get
from .joins import full_outer_on_key


def _d(value) -> Column:
    return value if isinstance(value, Column) else F.to_date(F.lit(value))


def _day_values(per_day: DataFrame, key: Sequence[str], value_cols: Sequence[str],
                month_start, day, fill) -> DataFrame:
    """(key..., value arrays over month_start..day, first_found_date); missing
    days = ``fill``."""
    m = (per_day.where((F.col("date") >= _d(month_start)) & (F.col("date") <= _d(day)))
         .groupBy(*key).agg(*[
             F.map_from_entries(F.collect_list(F.struct("date", c))).alias(f"_m_{c}")
             for c in value_cols], F.min("date").alias("first_found_date")))
    days = F.sequence(_d(month_start), _d(day), F.expr("INTERVAL 1 DAY"))
    def lookup(c):
        m = F.col(f"_m_{c}")
        if fill is None:
            return lambda d: F.try_element_at(m, d)
        return lambda d: F.coalesce(F.try_element_at(m, d), F.lit(fill))

    arrays = [F.transform(days, lookup(c)).alias(c) for c in value_cols]
    return m.select(*key, *arrays, "first_found_date")


# --- P18: monthly hit array snapshot (NULL padded) -----------------------

def monthly_hits_backfill(activity: DataFrame, *, key: str, month_start, day) -> DataFrame:
    """Closed form of the snapshot at ``day``: NULL for days without hits."""
    arr = _day_values(activity, [key], ["n_events"], month_start, day, None) \
        .withColumnRenamed("n_events", "hit_array")
    return (arr
            .select(key, "hit_array", _d(month_start).alias("month_start"), "first_found_date",
                    _d(day).alias("date_partition")))


def monthly_hits_step(prev: DataFrame, today: DataFrame, *, key: str, month_start,
                      day) -> DataFrame:
    """P18 step: prev snapshot (day − 1) ⟗ today's counts."""
    offset = F.datediff(_d(day), _d(month_start))
    y = prev.select(key, "hit_array", "first_found_date")
    t = today.select(key, F.col("n_events").alias("num_hits"), F.col("date").alias("today_date"))
    j = full_outer_on_key(y, t, key)
    pad = F.array_repeat(F.lit(None).cast("bigint"), offset)
    kept = F.coalesce(F.slice(F.col("y.hit_array"), 1, offset), pad)
    padded = F.concat(kept, F.array_repeat(F.lit(None).cast("bigint"),
                                           F.greatest(offset - F.size(kept), F.lit(0))))
    return j.select(
        F.coalesce(F.col(f"y.{key}"), F.col(f"t.{key}")).alias(key),
        F.concat(padded, F.array(F.col("t.num_hits").cast("bigint"))).alias("hit_array"),
        _d(month_start).alias("month_start"),
        F.least(F.col("y.first_found_date"), F.col("t.today_date")).alias("first_found_date"),
        _d(day).alias("date_partition"))


def first_days_totals(snapshot: DataFrame, *, date_partition=None, n: int = 3) -> DataFrame:
    """Per month, the total of the first ``n`` days; safe on short or
    empty arrays (0 instead of an error)."""
    df = snapshot
    if date_partition is not None:
        df = df.where(F.col("date_partition") == date_partition)
    names = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh"]
    return df.groupBy("month_start").agg(*[
        F.sum(safe_get(F.col("hit_array"), i, 0)).cast("bigint")
        .alias(f"num_hits_{names[i] if i < len(names) else str(i + 1)}_day") for i in range(n)])


# --- P19/P20: zero-filled metric arrays, upserted ------------------------

def metric_array_backfill(per_day: DataFrame, *, key: Sequence[str], metrics: Sequence[str],
                          month_start, day) -> DataFrame:
    """Closed form: for each key active in the month up to ``day``, one
    zero-filled array per metric over the days month_start..day."""
    out = _day_values(per_day, list(key), list(metrics), month_start, day, 0).drop("first_found_date")
    return out.withColumn("month_start", _d(month_start))


def metric_array_step(prev: DataFrame, today: DataFrame, *, key: Sequence[str],
                      metrics: Sequence[str], month_start, day) -> DataFrame:
    """P19/P20 step: idempotent append of today's values at the day offset."""
    key = list(key)
    offset = F.datediff(_d(day), _d(month_start))
    y = prev.where(F.col("month_start") == _d(month_start)).select(*key, *metrics)
    t = today.select(*key, *[F.col(m).alias(f"_t_{m}") for m in metrics])
    j = full_outer_on_key(y, t, key)
    cols = [F.coalesce(F.col(f"y.{k}"), F.col(f"t.{k}")).alias(k) for k in key]
    for m in metrics:
        kept = F.coalesce(F.slice(F.col(f"y.{m}"), 1, offset), F.array().cast("array<bigint>"))
        pad = F.array_repeat(F.lit(0).cast("bigint"), F.greatest(offset - F.size(kept), F.lit(0)))
        today_v = F.coalesce(F.col(f"t._t_{m}").cast("bigint"), F.lit(0).cast("bigint"))
        cols.append(F.concat(kept.cast("array<bigint>"), pad, F.array(today_v)).alias(m))
    return j.select(*cols, _d(month_start).alias("month_start"))


def upsert(existing: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ON CONFLICT (keys) DO UPDATE: rows of ``updates`` replace same-key rows,
    NULL keys equal."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"e.{k}").eqNullSafe(F.col(f"u.{k}"))
    return (existing.alias("e").join(updates.select(*keys).alias("u"), cond, "left_anti")
            .unionByName(updates.select(*existing.columns)))


def metric_daily(state: DataFrame, *, group: Sequence[str], array_col: str,
                 value_name: str = "value") -> DataFrame:
    """Array → one row per (group, day): element i (0-based) belongs to
    month_start + i; summed over keys, any array length."""
    exploded = state.select(*group, "month_start", F.posexplode(array_col).alias("pos", "v"))
    return (exploded.groupBy(*group, F.date_add("month_start", F.col("pos")).alias("date"))
            .agg(F.sum("v").cast("bigint").alias(value_name)))
