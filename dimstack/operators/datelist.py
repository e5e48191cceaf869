"""Date lists and bit-packed activity.

* ``daily_activity`` reduces raw events to one row per (key, day) with a
  group-by: partial aggregation collapses a hot key's events map-side.
* Steps join yesterday's state with today's activity (one full outer join,
  null keys dropped first); backfills are one group-by per key that collects
  the key's distinct active days (at most one entry per day of the range).
* Bit packing folds the date array with ``aggregate``: no cross join with a
  date series, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import append_if, bits_from_offsets, empty_array, pow2
from ..functions.scalar import LOW32_MASK, NEXT7_MASK, TOP7_MASK, bit_count
from ..schemas import UNKNOWN_DEVICE_PREFIX
from .joins import full_outer_on_key
from .quality import distinct_rows


def _d(value) -> Column:
    return value if isinstance(value, Column) else F.to_date(F.lit(value))


def in_days(events: DataFrame, *, start=None, end=None, ts_col: str = "event_time") -> DataFrame:
    """Events of the days start..end, as a range on the raw timestamp so the
    parquet scan can skip row groups (not a comparison of a truncated value)."""
    df = events
    if start is not None:
        df = df.where(F.col(ts_col) >= _day_start(start, events, ts_col))
    if end is not None:
        df = df.where(F.col(ts_col) < _day_start(F.date_add(_d(end), 1), events, ts_col))
    return df


def _day_start(day, events: DataFrame, ts_col: str) -> Column:
    """Midnight of ``day`` in the type of ``ts_col`` (NTZ stays NTZ, so the
    comparison needs no cast of the column and is pushed into the scan)."""
    from pyspark.sql import types as T
    ntz = isinstance(events.schema[ts_col].dataType, T.TimestampNTZType)
    return _d(day).cast("timestamp_ntz" if ntz else "timestamp")


def daily_activity(events: DataFrame, key: str | Sequence[str], ts_col: str = "event_time",
                   start=None, end=None) -> DataFrame:
    """(key, date, n_events) for non-null keys of the days start..end."""
    keys = [key] if isinstance(key, str) else list(key)
    df = in_days(events, start=start, end=end, ts_col=ts_col)
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return (df.groupBy(*keys, F.to_date(ts_col).alias("date"))
            .agg(F.count(F.lit(1)).alias("n_events")))


def datelist_step(prev: DataFrame, today: DataFrame, *, key: str, today_date,
                  list_col: str = "dates_active") -> DataFrame:
    """P11/P17 step: ``prev`` (key, list_col, date) ⟗ today's (key, date)."""
    t = today.select(key, F.col("date").alias("today_date"))
    j = full_outer_on_key(prev.select(key, list_col, "date"), t, key)
    return j.select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        append_if(F.col(f"y.{list_col}"), F.col(f"t.{key}").isNotNull(), F.col("t.today_date"),
                  "date").alias(list_col),
        F.coalesce(F.col("t.today_date"), F.date_add(F.col("y.date"), 1)).alias("date"))


def datelist_backfill(activity: DataFrame, *, key: str, as_of,
                      list_col: str = "dates_active") -> DataFrame:
    """One-shot state at ``as_of``: sorted distinct active days <= as_of."""
    a = activity.where(F.col("date") <= _d(as_of))
    return (a.groupBy(key).agg(F.array_sort(F.collect_set("date")).alias(list_col))
            .withColumn("date", _d(as_of)))


def datelist_int(state: DataFrame, *, key: str, as_of, list_col: str = "dates_active",
                 compat: bool = False) -> DataFrame:
    """32-day activity integer; bit 31 = as_of, bit 0 = as_of − 31.

    ``compat`` reproduces the reference's exponent ``32 − days`` with the
    value truncated to 32 bits (today's activity falls off, Q10)."""
    offsets = F.transform(F.col(list_col), lambda d: F.datediff(_d(as_of), d))
    if compat:
        # exponent 32 - d for d in 0..31, then keep the low 32 bits
        bits = F.aggregate(
            F.array_distinct(offsets), F.lit(0).cast("bigint"),
            lambda acc, d: F.when((d >= 0) & (d < 32),
                                  acc + pow2(32 - d))
            .otherwise(acc)).bitwiseAND(F.lit(LOW32_MASK))
    else:
        bits = bits_from_offsets(offsets, 32)
    return state.select(key, bits.alias("datelist_int"), _d(as_of).alias("date"))


def activity_flags(bits: DataFrame, *, key: str, bits_col: str = "datelist_int") -> DataFrame:
    """Monthly / weekly activity from the 32-bit integer."""
    b = F.col(bits_col)
    return bits.select(
        key, b.alias(bits_col),
        (bit_count(b) > 0).alias("monthly_active"),
        bit_count(b).alias("l32"),
        (bit_count(b.bitwiseAND(F.lit(TOP7_MASK))) > 0).alias("weekly_active"),
        bit_count(b.bitwiseAND(F.lit(TOP7_MASK))).alias("l7"),
        (bit_count(b.bitwiseAND(F.lit(NEXT7_MASK))) > 0).alias("weekly_active_previous_week"))


# --- per-device date lists (P14-P16) -------------------------------------

def browser_activity(events: DataFrame, devices: DataFrame, *, day=None,
                     start=None, end=None) -> DataFrame:
    """(user_id, browser_type, date): events with a user, one per (user,
    device, day), named by the device's browser, ``UNKNOWN_DEVICE_<id>`` when
    the device is not in the dimension."""
    if day is not None:
        start = end = day
    act = daily_activity(events, ["user_id", "device_id"], start=start, end=end) \
        .select("user_id", "device_id", "date")
    dev = distinct_rows(devices.where(F.col("device_id").isNotNull())
                        .select("device_id", "browser_type"))
    j = act.join(dev, "device_id", "left")
    browser = F.coalesce(F.col("browser_type"),
                         F.concat(F.lit(UNKNOWN_DEVICE_PREFIX), F.col("device_id").cast("string")))
    return distinct_rows(j.select("user_id", browser.alias("browser_type"), "date"))


def device_datelist_backfill(activity: DataFrame, *, as_of) -> DataFrame:
    """State at ``as_of``: one row per (user, browser) with its sorted dates.
    Long form: a user with any number of browsers is any number of rows."""
    return (activity.where(F.col("date") <= _d(as_of))
            .groupBy("user_id", "browser_type")
            .agg(F.array_sort(F.collect_set("date")).alias("dates_active"))
            .withColumn("date", _d(as_of)))


def device_datelist_step(prev: DataFrame, today_activity: DataFrame, *, today) -> DataFrame:
    """P14 step: yesterday's (user, browser) rows ⟗ today's; the date lists are
    concatenated."""
    t = (today_activity.groupBy("user_id", "browser_type")
         .agg(F.array_sort(F.collect_set("date")).alias("dates_active")))
    j = full_outer_on_key(prev.select("user_id", "browser_type", "dates_active", "date"), t,
                          ["user_id", "browser_type"])
    none = empty_array("date")
    return j.select(*[F.coalesce(F.col(f"t.{c}"), F.col(f"y.{c}")).alias(c)
                      for c in ("user_id", "browser_type")],
                    F.concat(F.coalesce(F.col("y.dates_active"), none),
                             F.coalesce(F.col("t.dates_active"), none)).alias("dates_active"),
                    F.when(F.col("t.user_id").isNotNull(), _d(today))
                    .otherwise(F.date_add(F.col("y.date"), 1)).alias("date"))


def device_day_matrix(state: DataFrame, *, start, end) -> DataFrame:
    """Per (user, browser) a 0/1 array over the days start..end and its sum."""
    days = F.sequence(_d(start), _d(end), F.expr("INTERVAL 1 DAY"))
    flags = F.transform(days, lambda d: F.when(F.array_contains("dates_active", d), 1).otherwise(0))
    return state.select(
        "user_id", "browser_type", flags.alias("datelist_int_array"),
        F.aggregate(flags, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("bit_count"))


def any_device_bits(state: DataFrame, *, start, end) -> DataFrame:
    """Activity integer over any browser; bit 0 = ``start``.  The browsers'
    integers are combined by OR before the shuffle."""
    span = F.datediff(_d(end), _d(start)) + 1
    offset = lambda d: F.datediff(d, _d(start))
    bits = F.aggregate(
        "dates_active", F.lit(0).cast("bigint"),
        lambda acc, d: F.when((offset(d) >= 0) & (offset(d) < span), acc.bitwiseOR(pow2(offset(d))))
        .otherwise(acc))
    any_ = state.groupBy("user_id").agg(F.bit_or(bits).alias("datelist_bits"))
    return any_.select("user_id", "datelist_bits", bit_count(F.col("datelist_bits")).alias("active_days"))
