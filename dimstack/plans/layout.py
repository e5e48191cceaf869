"""Layout reports.

Both write real tables under the shared checkpoint folder
(``spark.checkpoint.dir``) and report what is read back from them, so the
result is a function of the data; the plans and file counts are checked in
tests/test_plans.py.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_path
from ..sources.files import save_table
from .clustering import z_order
from .days import materialize


def bucket_join_report(spark: SparkSession, details: DataFrame, matches: DataFrame,
                       medals: DataFrame, key: str = "match_id", buckets: int = 16) -> DataFrame:
    """Details ⋈ matches ⋈ medals per match on ``key``, as plain tables
    and as tables bucketed (and sorted) by ``key`` into ``buckets``.

    Returns per variant and playlist the joined rows, kills and medals; both
    variants must agree.  ``match_join`` builds one variant's frame, whose plan
    shows the exchanges that bucketing saves.  The tables stay under the shared
    checkpoint folder for as long as the lazy result may read them."""
    tag = uuid.uuid4().hex[:10]
    base = checkpoint_path(spark, "bucketed", tag)
    frames = {"details": details, "matches": matches, "medals": medals}
    for name, df in frames.items():
        save_table(df, f"bucket_{name}_{tag}", path=f"{base}/{name}", bucket_col=key, buckets=buckets)
    bucketed = [spark.table(f"bucket_{name}_{tag}") for name in frames]
    out = None
    for label, (d, m, x) in {"plain": (details, matches, medals), "bucketed": tuple(bucketed)}.items():
        row = (match_join(d, m, x, key).groupBy("playlist_id")
               .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("player_total_kills").alias("kills"),
                    F.sum(F.coalesce("n_medals", F.lit(0))).alias("n_medals"))
               .select(F.lit(label).alias("variant"), "*"))
        out = row if out is None else out.unionByName(row)
    return out


def match_join(details: DataFrame, matches: DataFrame, medals: DataFrame, key: str) -> DataFrame:
    """The three tables joined on ``key`` (medals summed per match first).  The
    merge hint keeps a broadcast from hiding the co-location."""
    per_match = medals.groupBy(key).agg(F.sum("count").alias("n_medals"))
    return (details.join(matches.hint("merge"), key)
            .join(per_match.hint("merge"), key, "left"))


def layout_report(spark: SparkSession, df: DataFrame, *, partition_col: str,
                  sorts: Mapping[str, Sequence[str]],
                  global_sorts: Mapping[str, Sequence[str]] | None = None,
                  z_orders: Mapping[str, Sequence[str]] | None = None,
                  checksum: str = "event_id", partitions: int | None = None) -> DataFrame:
    """Write ``df`` once per sort variant and report rows, distinct
    ``partition_col`` values and an order-free checksum read back from each.

    Variants repartition by ``partition_col`` (``partitions`` tasks, by default
    the session's shuffle partitions, so AQE sizes them by bytes) and sort
    within partitions; ``global_sorts`` use one total ``sort`` instead (O03),
    ``z_orders`` ranges of interleaved ranks.  The input is computed once.
    ``written_layouts`` gives the folders for ``clustering.layout_sizes``."""
    out = None
    for label, path in written_layouts(spark, df, partition_col=partition_col, sorts=sorts,
                                       global_sorts=global_sorts, z_orders=z_orders,
                                       partitions=partitions).items():
        row = spark.read.parquet(path).agg(
            F.count(F.lit(1)).alias("n_rows"), F.countDistinct(partition_col).alias("n_values"),
            F.sum(checksum).alias("checksum")).select(F.lit(label).alias("variant"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def written_layouts(spark: SparkSession, df: DataFrame, *, partition_col: str,
                    sorts: Mapping[str, Sequence[str]],
                    global_sorts: Mapping[str, Sequence[str]] | None = None,
                    z_orders: Mapping[str, Sequence[str]] | None = None,
                    partitions: int | None = None) -> dict[str, str]:
    """Write each variant of ``layout_report``; the folder per variant."""
    tag = uuid.uuid4().hex[:10]
    df = materialize(df, "layout_input")
    paths = {}
    for label, cols, kind in [*((k, v, "within") for k, v in sorts.items()),
                              *((k, v, "global") for k, v in (global_sorts or {}).items()),
                              *((k, v, "z") for k, v in (z_orders or {}).items())]:
        by = [F.col(partition_col)]
        if kind == "global":
            shaped = df.sort(*cols)
        elif kind == "z":
            shaped = z_order(df, cols, partitions)
        else:
            shaped = df.repartition(partitions, *by) if partitions else df.repartition(*by)
            shaped = shaped.sortWithinPartitions(*cols) if cols else shaped
        paths[label] = checkpoint_path(spark, "layout", tag, label)
        shaped.write.mode("overwrite").parquet(paths[label])
    return paths
