"""Exact distinct visitors over any span of days from one stored table (A03,
A05, P20).

Daily distinct counts cannot be added up; bitmaps can be merged.  The table has
one bitmap of 32,768 positions for each (keys, day, bucket of ids) that occurs,
so a week or a month reads bitmaps and never the events again.  A hot key is
reduced to its bitmaps in every task before the shuffle.  Ids are whole numbers;
they should be dense (a dictionary's numbers), since a bitmap takes 4 KB however
few of its positions are set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Spans that ``visitors_by`` knows: the first day of each.
SPANS = {"day": lambda d: d, "week": lambda d: F.to_date(F.date_trunc("week", d)),
         "month": lambda d: F.to_date(F.date_trunc("month", d))}


def daily_visitors(events: DataFrame, keys: Sequence[str], *, id_col: str = "user_id",
                   ts_col: str = "event_time") -> DataFrame:
    """``(*keys, day, bucket, visitors)``: the ids of each day as bitmaps.  Rows
    without an id or a time have no visitor; NULL keys are a key."""
    known = events.where(F.col(id_col).isNotNull() & F.col(ts_col).isNotNull())
    return (known.groupBy(*keys, F.to_date(ts_col).alias("day"), F.bitmap_bucket_number(id_col).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("visitors")))


def visitors_by(daily: DataFrame, keys: Sequence[str], span: str) -> DataFrame:
    """``(span, *keys, first_day, n_visitors)`` from the daily bitmaps, for
    ``span`` day, week (from Monday) or month."""
    merged = (daily.groupBy(*keys, SPANS[span](F.col("day")).alias("first_day"), "bucket")
              .agg(F.bitmap_or_agg("visitors").alias("visitors")))
    return (merged.groupBy(*keys, "first_day").agg(F.sum(F.bitmap_count("visitors")).alias("n_visitors"))
            .select(F.lit(span).alias("span"), *keys, "first_day", "n_visitors"))


def visitors_between(daily: DataFrame, keys: Sequence[str], first: str, last: str) -> DataFrame:
    """``(*keys, n_visitors)`` over the days ``first`` to ``last``, both included."""
    merged = (daily.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
              .groupBy(*keys, "bucket").agg(F.bitmap_or_agg("visitors").alias("visitors")))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("visitors")).alias("n_visitors"))
