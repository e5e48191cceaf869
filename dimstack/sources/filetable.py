"""A Parquet table as a list of files, for upserts that rewrite only the files
that hold a changed key (S14).

``<path>/data/<commit>/`` has the files, ``<path>/manifest/v<n>`` lists those of
version n, one a line.  A commit writes its new files first and then the next
manifest under its final name by one rename; until then readers see the old
version, and a stopped writer leaves nothing but files that no manifest names.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import remove_path


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def version(spark: SparkSession, path: str) -> int:
    """The latest committed version; 0 if there is none."""
    fs, folder = _fs(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return max((int(n[1:]) for n in names if n[0] == "v"), default=0)


def files_of(spark: SparkSession, path: str, at: int | None = None) -> list[str]:
    """The files of a version (default: the latest)."""
    at = version(spark, path) if at is None else at
    if not at:
        return []
    return [r.value for r in spark.read.text(f"{path}/manifest/v{at}").collect() if r.value]


def read(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    """The table at a version (default: the latest)."""
    files = files_of(spark, path, at)
    if not files:
        raise ValueError(f"no version of a table at {path}")
    return spark.read.parquet(*files)


def stage(spark: SparkSession, df: DataFrame, path: str) -> list[str]:
    """Write ``df`` as new files of the table that no version names yet."""
    folder = f"{path}/data/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    fs, hadoop_path = _fs(spark, folder)
    return sorted(s.getPath().toString() for s in fs.listStatus(hadoop_path) if s.getPath().getName().startswith("part-"))


def commit(spark: SparkSession, path: str, files: Sequence[str], base: int) -> int:
    """Make ``files`` version ``base + 1``; an error if another writer was first."""
    draft = f"{path}/draft/{uuid.uuid4().hex}"
    spark.createDataFrame([(f,) for f in files] or [("",)], "value string").coalesce(1).write.text(draft)
    fs, folder = _fs(spark, draft)
    part = next(s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    _, manifest = _fs(spark, f"{path}/manifest")
    fs.mkdirs(manifest)
    _, target = _fs(spark, f"{path}/manifest/v{base + 1}")
    if fs.exists(target) or not fs.rename(part, target):
        raise RuntimeError(f"version {base + 1} of {path} exists: read it and repeat the upsert")
    remove_path(spark, draft)
    return base + 1


def create(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Version 1."""
    return commit(spark, path, stage(spark, df, path), 0)


def touched_files(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], at: int) -> list[str]:
    """Files of version ``at`` that hold a key of ``updates`` (NULL keys equal);
    only the key columns are read."""
    held = read(spark, path, at).select(*keys, F.col("_metadata.file_path").alias("__file"))
    rows = held.alias("e").join(updates.select(*keys).distinct().alias("u"), _same(keys), "left_semi")
    return sorted(r[0] for r in rows.select("__file").distinct().collect())


def _same(keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"e.{k}").eqNullSafe(F.col(f"u.{k}"))
    return cond


def prepare_upsert(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str]) -> tuple[list[str], int]:
    """Everything of an upsert but its commit: ``(files of the next version,
    version it builds on)``.  ``updates`` has the table's columns and one row per
    key; rows of the touched files without an update are written again, new
    keys go to the new files, all other files stay as they are."""
    base = version(spark, path)
    now = read(spark, path, base)
    if set(now.columns) != set(updates.columns):
        raise ValueError(f"updates have columns {sorted(updates.columns)}, the table has {sorted(now.columns)}")
    if updates.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError("updates have more than one row for a key")
    old = set(touched_files(spark, path, updates, keys, base))
    files = files_of(spark, path, base)
    new = updates.select(*now.columns)
    if old:
        rest = spark.read.schema(now.schema).parquet(*sorted(old)).alias("e").join(
            updates.select(*keys).alias("u"), _same(keys), "left_anti")
        new = rest.unionByName(new)
    return [f for f in files if _name(f) not in {_name(x) for x in old}] + stage(spark, new, path), base


def _name(file: str) -> str:
    """Commit folder and file: the same however a scheme is spelled."""
    return "/".join(file.rsplit("/", 2)[-2:])


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str]) -> int:
    """Insert or replace by key; returns the new version."""
    files, base = prepare_upsert(spark, path, updates, keys)
    return commit(spark, path, files, base)
