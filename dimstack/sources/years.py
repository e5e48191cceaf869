"""Tables partitioned by the year of a date column (S15): the year is a derived
partition column, and a range of dates becomes a range of years as well, so a
filter on the date alone prunes partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def year_column(date_col: str) -> str:
    return f"{date_col}_year"


def write_by_year(df: DataFrame, path: str, date_col: str, files_per_year: int | None = None) -> None:
    """Write ``df`` partitioned by the year of ``date_col`` (NULL dates have a
    partition of their own).  Rows are dealt by year and, with ``files_per_year``,
    a hash of the date, so a year with most of the rows is many tasks."""
    year = F.year(date_col)
    parts = [year]
    if files_per_year:
        parts.append(F.pmod(F.xxhash64(date_col), F.lit(files_per_year)))
    (df.withColumn(year_column(date_col), year).repartition(*parts)
     .write.mode("overwrite").partitionBy(year_column(date_col)).parquet(path))


def read_between(spark: SparkSession, path: str, date_col: str, first: str | None = None,
                 last: str | None = None) -> DataFrame:
    """The rows with ``date_col`` from ``first`` to ``last`` (days, both included;
    None: open), without the year column."""
    df = spark.read.parquet(path)
    year, day = F.col(year_column(date_col)), F.to_date(date_col)
    if first is not None:
        df = df.where((year >= dt.date.fromisoformat(first).year) & (day >= F.lit(first).cast("date")))
    if last is not None:
        df = df.where((year <= dt.date.fromisoformat(last).year) & (day <= F.lit(last).cast("date")))
    return df.drop(year_column(date_col))
