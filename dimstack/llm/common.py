"""Shared helpers: tables, the shared scratch folder, keys, skew-safe joins."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that hold more than 1/HEAVY of all rows: fewer than HEAVY exist, so the
#: rows that describe them can be broadcast whatever the size of the input.
HEAVY = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the first use in an application ships this package."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark application: Python
    workers elsewhere may not have it on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_dimstack_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="dimstack-zip-")) / "dimstack_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._dimstack_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a
    cluster without it is an error, since a machine-local folder is invisible
    to the other executors.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="dimstack-llm-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared scratch folder of this session."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/llm-{app}/{name}-{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> None:
    """Delete this session's written intermediates.  Call it when the results
    built on them have been consumed."""
    path = f"{scratch_root(spark)}/llm-{spark.sparkContext.applicationId}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(hadoop_path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage and survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_by_document(docs: DataFrame, found: DataFrame, how: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Join ``docs`` with ``found`` (first column: document id, second: text
    key, at most one row for each) on both, NULL ids equal.  The columns of
    ``docs`` come first; the others of ``found`` follow as one struct in the
    last column, whatever names ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    fresh = []
    for stem in ("doc", "key", "found"):
        while stem in taken:
            stem += "_"
        fresh.append(stem)
    side = found.select(found[0].alias(fresh[0]), found[1].alias(fresh[1]),
                        F.struct(F.lit(True).alias("hit"), *found.columns[2:]).alias(fresh[2]))
    cond = F.col(id_col).eqNullSafe(F.col(fresh[0])) & (text_key(text_col) == F.col(fresh[1]))
    out = docs.join(side.hint("merge"), cond, how)
    return out if how in ("left_semi", "left_anti") else out.select(*docs.columns, fresh[2])


def fresh_name(df: DataFrame, stem: str = "__text") -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def text_key(text: str = "text"):
    """64-bit key of a whole text.  With the document id it names a row by its
    content: rows that agree on both have the same result in every operator."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def join_dimension(facts: DataFrame, dim: DataFrame, keys: list[str], count: str,
                   total: int) -> DataFrame:
    """Left join of ``facts`` with ``dim`` (one row per key, ``count`` = rows of
    ``facts`` with that key) that stays balanced when keys are hot.

    Keys above ``total / HEAVY`` rows (fewer than HEAVY by construction) are
    broadcast; the other keys meet in an ordinary shuffle join, in which no key
    holds more than a thousandth of the rows.
    """
    limit = max(1, total // HEAVY)
    cols = [c for c in dim.columns if c not in keys and c != count]
    heavy = F.broadcast(dim.filter(F.col(count) > limit).select(*keys, *cols))
    light = dim.filter(F.col(count) <= limit).select(*keys, *cols)
    hot = facts.join(heavy, keys)
    cold = facts.join(heavy.select(*keys), keys, "left_anti").join(light.hint("merge"), keys, "left")
    return hot.unionByName(cold)


def arrow_batches(build, batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Apply ``build(batch) -> dict of columns`` to each Arrow batch."""
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_pydict(build(batch), schema=schema)


def arrow_schema(df: DataFrame, columns: list[str], extra: list[tuple[str, pa.DataType]]) -> pa.Schema:
    """Arrow types of some columns of ``df`` followed by new ones."""
    from pyspark.sql.pandas.types import to_arrow_type
    kept = [(c, to_arrow_type(df.schema[c].dataType)) for c in columns]
    return pa.schema(kept + extra)
