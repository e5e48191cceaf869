"""Readers and writers.

* CSV: all-string, inferred, or with an explicit schema (preferred: no
  extra pass over the data).
* Snapshot tables are partitioned by their period column and written with
  dynamic partition overwrite, so re-running a day rewrites only that day.
* Upserts rewrite the touched partitions (Parquet has no MERGE).
* Bucketed tables (bucketBy + sortBy) let later joins on the bucket key skip
  the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, *, schema: T.StructType | None = None,
             infer: bool = False) -> DataFrame:
    """S01 (strings), S02 (inferred types), S03 (explicit schema)."""
    r = spark.read.option("header", True)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", infer).csv(path)


def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str],
                     fmt: str = "parquet") -> None:
    """Overwrite only the partitions present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(path))


def insert_overwrite(df: DataFrame, table: str) -> None:
    """INSERT OVERWRITE by position into a catalog table (dynamic)."""
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def append_into(df: DataFrame, table: str) -> None:
    """INSERT INTO ... SELECT."""
    df.write.mode("append").insertInto(table)


def save_table(df: DataFrame, table: str, *, path: str | None = None,
               partition_cols: Sequence[str] = (), bucket_col: str | None = None,
               buckets: int = 16) -> None:
    """saveAsTable (overwrite), optionally partitioned and
    bucketed + sorted on ``bucket_col``; ``path`` makes it an external table
    under shared storage."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if bucket_col:
        w = w.bucketBy(buckets, bucket_col).sortBy(bucket_col)
    w.saveAsTable(table)


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None only if the path does not exist.  Any other
    read error rises."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this session wrote (staging, intermediates)."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def upsert_partitions(spark: SparkSession, updates: DataFrame, path: str,
                      keys: Sequence[str], partition_cols: Sequence[str]) -> None:
    """ON CONFLICT (keys) DO UPDATE for a partitioned Parquet table:
    the touched partitions are rewritten as existing-minus-updated plus
    updates.  Keys compare null-safe.  The updates must have the table's
    columns.  The result is materialised at a staging path first (reading
    and overwriting one path in one job is unsafe), which is removed after."""
    import uuid
    existing = existing_table(spark, path)
    merged = updates
    if existing is not None:
        if set(updates.columns) != set(existing.columns):
            raise ValueError(f"updates have columns {sorted(updates.columns)}, "
                             f"the table has {sorted(existing.columns)}")

        def same(cols):
            cond = F.lit(True)
            for c in cols:
                cond = cond & F.col(f"e.{c}").eqNullSafe(F.col(f"u.{c}"))
            return cond
        parts = updates.select(*partition_cols).distinct().alias("u")
        touched = existing.alias("e").join(parts, same(partition_cols), "left_semi")
        merged = (touched.alias("e").join(updates.select(*keys).alias("u"), same(keys), "left_anti")
                  .unionByName(updates.select(*existing.columns)))
    staging = f"{path.rstrip('/')}_staging_{uuid.uuid4().hex}"
    merged.write.mode("overwrite").partitionBy(*partition_cols).parquet(staging)
    write_partitions(spark.read.schema(merged.schema).parquet(staging), path, partition_cols)
    remove_path(spark, staging)


def truncate(spark: SparkSession, table: str) -> None:
    """S20."""
    spark.sql(f"TRUNCATE TABLE {table}")


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Total bytes and number of data files of a Parquet folder, from
    the hidden ``_metadata`` column (one row)."""
    files = (spark.read.parquet(path)
             .select(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_size").alias("size"))
             .distinct())
    return files.agg(F.sum("size").cast("bigint").alias("total_bytes"),
                     F.count(F.lit(1)).alias("n_files"))


def create_table_as(spark: SparkSession, table: str, df: DataFrame, *,
                    path: str | None = None, partition_cols: Sequence[str] = ()) -> None:
    """CREATE TABLE ... USING parquet AS SELECT (the frame is passed as
    a parameterised relation, no temp view needed)."""
    loc = f" LOCATION '{path}'" if path else ""
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE {table} USING parquet{part}{loc} AS SELECT * FROM {{src}}", src=df)


def create_staging_table(spark: SparkSession, table: str, columns: str, *,
                         partition_cols: str = "ds STRING", path: str | None = None) -> None:
    """Partitioned staging table from a column list (array columns allowed)."""
    loc = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {partition_cols}) USING parquet "
              f"PARTITIONED BY ({partition_cols.split()[0]}){loc}")


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """S18."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def drop_table(spark: SparkSession, table: str) -> None:
    """S18."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
