"""Scans of the driver's parquet tables and catalog tables.

Reads are lazy and column selection happens in the callers, so Catalyst
prunes the parquet ``ReadSchema`` and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Register driver tables as temp views so SQL text can use them."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table by name."""
    return spark.table(name)
