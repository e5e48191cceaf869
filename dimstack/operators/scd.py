"""Slowly changing dimension type 2.

Backfill: gaps and islands.  A row starts a streak when any tracked attribute
differs (null-safe) from the previous row of the key, or there is no previous
row; the running count of starts is the streak id; each (key, streak) becomes
one record with its first and last period.  The window is partitioned by the
key and the input grain is one row per (key, period), so a partition holds at
most one row per period.  The following group-by is on (key, streak, ...),
a superset of the window's partitioning, so it adds no shuffle.

Incremental: one full outer join of the open records with the new snapshot;
each joined row emits its output records through ``inline(array(...))``;
closed records pass through by a union (no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import full_outer_on_key


def _attrs_differ(a_prefix: str, b_prefix: str, attrs: Sequence[str]):
    cond = None
    for a in attrs:
        c = ~F.col(f"{a_prefix}{a}").eqNullSafe(F.col(f"{b_prefix}{a}"))
        cond = c if cond is None else cond | c
    return cond


def scd2_backfill(state: DataFrame, *, key: str, attrs: Sequence[str], period: str,
                  as_of: int | None = None, start_col: str = "start_period",
                  end_col: str = "end_period", current_col: str | None = None) -> DataFrame:
    """P05 (one attribute) / P06 (several, bounded by ``as_of``)."""
    df = state.select(key, *attrs, period)
    if as_of is not None:
        df = df.where(F.col(period) <= as_of)
    w = Window.partitionBy(key).orderBy(period)
    changed = F.lit(False)
    for a in attrs:
        changed = changed | ~F.col(a).eqNullSafe(F.lag(a, 1).over(w))
    started = F.when(F.lag(period, 1).over(w).isNull() | changed, 1).otherwise(0)
    streaks = (df.withColumn("_start", started)
               .withColumn("_streak", F.sum("_start").over(w)))
    out = streaks.groupBy(key, "_streak", *attrs).agg(
        F.min(period).alias(start_col), F.max(period).alias(end_col))
    cols = [key, *attrs, start_col, end_col]
    if current_col is not None:
        out = out.withColumn(current_col, F.lit(as_of))
        cols.append(current_col)
    return out.select(*cols)


def scd2_incremental(scd: DataFrame, snapshot: DataFrame, *, key: str,
                     attrs: Sequence[str], prev: int, cur: int,
                     start_col: str = "start_period", end_col: str = "end_period",
                     current_col: str = "current_period",
                     keep_absent: bool = True) -> DataFrame:
    """SCD records as of ``prev`` + snapshot of ``cur`` → records as of
    ``cur``.  ``<=>`` replaces ``<>`` (a NULL attribute no longer drops the
    row) and, with ``keep_absent``, open records of keys missing from the
    snapshot are kept unchanged.

    Every record has a way out.  Open is the record that reaches ``prev`` or
    has no end; a NULL end stays NULL while the attributes do and becomes
    ``prev`` when they change.  A rerun undoes the earlier run first: records
    that start at ``cur`` and end there are dropped and ends at ``cur`` go back
    to ``prev``, so it gives the same result.  Closed records, records that end
    after ``cur`` and records with a NULL key are kept as they are; snapshot
    rows with a NULL key belong to no record and open none."""
    base = scd.select(key, *attrs, start_col, end_col)
    start, end = F.col(start_col), F.col(end_col)
    opened_before = (start > prev) & (end == cur)
    base = base.where(~F.coalesce(opened_before, F.lit(False)))
    rolled = base.withColumn(end_col, F.when(end == cur, F.lit(prev).cast(base.schema[end_col].dataType))
                             .otherwise(end))
    is_open = F.col(key).isNotNull() & (end.isNull() | (end == prev))
    open_ = rolled.where(is_open)
    closed = rolled.where(~is_open)
    snap = snapshot.select(key, *attrs)
    j = full_outer_on_key(open_, snap, key)
    in_y, in_t = F.col(f"y.{key}").isNotNull(), F.col(f"t.{key}").isNotNull()
    differ = _attrs_differ("y.", "t.", attrs)

    def rec(prefix, start, end):
        return F.struct(*[F.col(f"{prefix}{a}").alias(a) for a in attrs],
                        start.alias(start_col), end.alias(end_col))

    endless = in_y & F.col(f"y.{end_col}").isNull()
    old_kept = rec("y.", F.col(f"y.{start_col}"), F.col(f"y.{end_col}"))
    old_closed = rec("y.", F.col(f"y.{start_col}"), F.lit(prev))
    extended = rec("t.", F.col(f"y.{start_col}"), F.when(~endless, F.lit(cur)))
    opened = rec("t.", F.lit(cur), F.when(~endless, F.lit(cur)))
    records = (F.when(in_y & in_t & ~differ, F.array(extended))
               .when(in_y & in_t & differ, F.array(old_closed, opened))
               .when(in_t, F.array(opened))
               .otherwise(F.array(old_kept)))
    if not keep_absent:
        j = j.where(in_t)
    emitted = j.select(F.coalesce(F.col(f"y.{key}"), F.col(f"t.{key}")).alias(key),
                       F.inline(records))
    return (emitted.unionByName(closed)
            .withColumn(current_col, F.lit(cur)))
