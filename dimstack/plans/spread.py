"""Rows dealt by key into as many partitions as their number asks for.

Work that keeps all rows of a key together (windows, several groupings within a
key) needs one shuffle by that key.  With a partition for every ROWS rows a
task's memory does not grow with the table; keys of more than HOT rows, which
would fill a partition of their own, are given apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .days import materialize

ROWS = 500_000
HOT = 50_000


def partitions_for(rows: DataFrame, per_task: int = ROWS) -> int:
    """How many partitions keep about ``per_task`` rows each (of a written
    table: the count comes from the file footers)."""
    return rows.count() // per_task + 1


def split_hot(rows: DataFrame, key: str, hot: int = HOT) -> tuple[DataFrame, DataFrame | None]:
    """``(rows of the other keys, rows of keys with more than hot rows)``; None
    if no key is hot.  Rows without a key are in neither."""
    rows = rows.where(F.col(key).isNotNull())
    often = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot).select(key),
                        "hot_keys")
    if often.isEmpty():
        return rows, None
    return rows.join(often, key, "left_anti"), rows.join(often, key, "left_semi")
