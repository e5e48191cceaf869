"""Clustering of files by several columns, and file skipping.

``z_order`` interleaves the bits of each column's rank and writes files by
ranges of the result, so a file covers a small box in all columns, where a sort
covers a small range of its first column only.  ``file_ranges`` reads the
smallest and largest value per file; ``files_touched`` keeps the files that a
filter on any of the columns can meet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a column's rank: 2 ** BITS ranges of about equal size.
BITS = 8


def _number(df: DataFrame, col: str) -> Column:
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(col).cast("double")
    # text: its first six bytes order it well enough for ranges
    return F.conv(F.rpad(F.substring(F.hex(F.col(col).cast("string")), 1, 12), 12, "0"), 16, 10).cast("double")


def rank_bounds(df: DataFrame, cols: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """For each column the values that cut its rows into 2 ** ``bits`` ranges,
    approximately: one aggregate of fixed size, whatever the input."""
    cuts = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(_number(df, c), cuts, 10_000).alias(c) for c in cols]).first()
    return {c: sorted(set(row[c] or [])) for c in cols}


def z_value(df: DataFrame, bounds: Mapping[str, Sequence[float]], bits: int = BITS) -> Column:
    """The interleaved bits of the columns' ranks (NULL ranks first)."""
    if len(bounds) * bits > 62:
        raise ValueError("too many columns for one BIGINT")
    out = F.lit(0).cast("bigint")
    for k, (col, cuts) in enumerate(bounds.items()):
        x = _number(df, col)
        # binary search over the sorted cuts, one comparison a bit
        limits = F.array(*[F.lit(float(c)) for c in cuts]) if cuts else F.array(F.lit(float("inf")))
        rank = F.when(x.isNull(), 0).otherwise(F.size(F.filter(limits, lambda c: c <= x)))
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("bigint")
            out = out + F.shiftleft(bit, b * len(bounds) + k)
    return out


def z_order(df: DataFrame, cols: Sequence[str], files: int | None = None, bits: int = BITS) -> DataFrame:
    """``df`` in about ``files`` partitions (default: the session's shuffle
    partitions), each a range of the interleaved ranks of ``cols``, sorted.  Rows
    of one value are split over partitions when it is more than a file's share."""
    bounds = rank_bounds(df, cols, bits)
    z = df.withColumn("__z", z_value(df, bounds, bits))
    # the columns themselves cut a hot z into parts
    by = [F.col("__z"), *[F.col(c) for c in cols]]
    dealt = z.repartitionByRange(files, *by) if files else z.repartitionByRange(*by)
    return dealt.sortWithinPartitions("__z", *cols).drop("__z")


def file_ranges(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """One row per file of a Parquet folder: ``file, bytes, n_rows`` and for each
    column ``<col>_min`` and ``<col>_max``; only those columns are read."""
    aggs = [f(c).alias(f"{c}_{name}") for c in cols for name, f in (("min", F.min), ("max", F.max))]
    return (spark.read.parquet(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), *cols)
            .groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("n_rows"), *aggs))


def files_touched(ranges: DataFrame, where: Mapping[str, tuple]) -> DataFrame:
    """The rows of ``file_ranges`` whose files may hold a row with every column
    of ``where`` between its two values (None: open)."""
    keep = F.lit(True)
    for col, (low, high) in where.items():
        if low is not None:
            keep = keep & (F.col(f"{col}_max") >= F.lit(low))
        if high is not None:
            keep = keep & (F.col(f"{col}_min") <= F.lit(high))
    return ranges.where(keep)


def read_touched(spark: SparkSession, path: str, ranges: DataFrame, where: Mapping[str, tuple]) -> DataFrame:
    """The rows that ``where`` selects, read from the files that it touches.  The
    driver gets file names only, as it does for any scan."""
    files = [r.file for r in files_touched(ranges, where).select("file").collect()]
    df = spark.read.schema(spark.read.parquet(path).schema).parquet(*files) if files else spark.read.parquet(path).limit(0)
    for col, (low, high) in where.items():
        if low is not None:
            df = df.where(F.col(col) >= F.lit(low))
        if high is not None:
            df = df.where(F.col(col) <= F.lit(high))
    return df


def layout_sizes(spark: SparkSession, paths: Mapping[str, str], cols: Sequence[str], where: Mapping[str, tuple]) -> DataFrame:
    """Per layout variant: ``variant, total_bytes, n_files``, and the files and
    bytes that the filter ``where`` touches."""
    out = None
    for label, path in paths.items():
        ranges = file_ranges(spark, path, cols)
        hit = files_touched(ranges, where).select("file", F.lit(1).alias("hit"))
        row = (ranges.join(hit, "file", "left").agg(
            F.sum("bytes").alias("total_bytes"), F.count(F.lit(1)).alias("n_files"),
            F.count("hit").alias("files_touched"), F.sum(F.when(F.col("hit") == 1, F.col("bytes")).otherwise(0)).alias("bytes_touched"))
            .select(F.lit(label).alias("variant"), "*"))
        out = row if out is None else out.unionByName(row)
    return out
