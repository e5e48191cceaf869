"""Day loop for incremental snapshot tables (the scheduler of §3.2).

Each day reads the previous day's partition, runs the step, and overwrites
only that day's partition.  Writing and re-reading every day cuts the
lineage (30 chained full outer joins would otherwise form one plan), and a
lost executor only costs the current day.

With a *state table* (``create_state_table``: partitioned by day, bucketed
and sorted by the key) the previous state is read bucketed, so the step's
full outer join shuffles only today's slice, never the whole state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import existing_table, write_partitions


def day_range(start: str, end: str) -> list[str]:
    d0, d1 = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return [(d0 + dt.timedelta(days=i)).isoformat() for i in range((d1 - d0).days + 1)]


def written_days(spark: SparkSession, path: str, partition_col: str = "date") -> set[str]:
    """Days already present under ``path`` (from the partition folders: the
    result has one row per day).  Only a missing folder means none: any other
    read error rises, so that a resumed run does not start over."""
    df = existing_table(spark, path)
    if df is None:
        return set()
    return {str(r[0]) for r in df.select(partition_col).distinct().collect()}


def create_state_table(spark: SparkSession, table: str, columns: str, *, key: str,
                       buckets: int, path: str, partition_col: str = "date") -> str:
    """A snapshot table partitioned by ``partition_col`` (DATE), bucketed and
    sorted by ``key`` into ``buckets`` (choose about data size / 256 MB per
    day), stored at ``path`` on shared storage."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {partition_col} DATE) "
              f"USING parquet PARTITIONED BY ({partition_col}) CLUSTERED BY ({key}) "
              f"SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return table


def _read(spark, path, table):
    return spark.table(table) if table else spark.read.parquet(path)


def _write(spark, out, path, table, partition_col):
    if table:
        cols = [c for c in spark.table(table).columns]
        prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            out.select(*cols).write.mode("overwrite").insertInto(table)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
    else:
        write_partitions(out, path, [partition_col])


def run_days(spark: SparkSession, step: Callable[[DataFrame | None, str], DataFrame],
             days: Iterable[str], path: str | None = None, *, table: str | None = None,
             partition_col: str = "date", initial: DataFrame | None = None,
             resume: bool = False) -> DataFrame:
    """Run ``step(prev_state, day)`` for each day; the state of day d is the
    partition ``partition_col = d`` of the Parquet folder ``path`` or of the
    catalog ``table`` (see ``create_state_table``).  With ``resume`` the
    days already written are skipped (a rerun after a failure continues
    where it stopped; each day's write is an idempotent partition
    overwrite).  Returns the table."""
    prev = initial
    done = set()
    if resume:
        done = ({str(r[0]) for r in spark.table(table).select(partition_col).distinct().collect()}
                if table else written_days(spark, path, partition_col))
    for day in days:
        if day not in done:
            out = step(prev, day).withColumn(partition_col, F.to_date(F.lit(day)))
            _write(spark, out, path, table, partition_col)
        prev = (_read(spark, path, table)
                .where(F.col(partition_col) == F.to_date(F.lit(day))))
    return _read(spark, path, table)


def materialize(df: DataFrame, name: str = "tmp") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: an intermediate that several branches of a plan consume is computed
    once (column pruning can keep Spark from reusing its exchange), and its
    lineage is cut, so a lost executor does not recompute it from the source."""
    import uuid

    from ..session import checkpoint_path
    spark = df.sparkSession
    path = checkpoint_path(spark, "materialized", spark.sparkContext.applicationId,
                           f"{name}_{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_materialized(spark: SparkSession) -> None:
    """Delete the intermediates that ``materialize`` wrote below this session's
    checkpoint folder.  Call it when the results built on them are consumed."""
    from ..session import checkpoint_path
    from ..sources.files import remove_path
    remove_path(spark, checkpoint_path(spark, "materialized", spark.sparkContext.applicationId))
