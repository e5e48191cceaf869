"""A training corpus from raw documents: quality rules, line dedup, SimHash
near-dedup, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the next stage's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimstack.llm import decontam, line_dedup, packing, quality, simhash
from dimstack.llm.common import materialize, ship_package, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the model keep."""
    ship_package(spark)
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).filter("kept").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier document holds."""
    kept = line_dedup.dedup_lines(docs, min_chars=10)
    cols = [F.length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(c)
            for c in docs.columns]
    return kept.select(*cols)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    ship_package(spark)
    return simhash.keep_one_per_group(docs, shingle=4, distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontam.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a training sequence."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

#: The stages use a trained model and a tokenizer, which SQL cannot express;
#: tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
