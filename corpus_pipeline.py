"""Training-corpus pipeline: five operators in a row over documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillbook.llm import bpe, decontaminate, pii, quality_rules, simhash
from tillbook.llm.shipping import ship
from tillbook.session import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship(spark)
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints of 3-word shingles linked at 2 bits."""
    ship(spark)
    return simhash.drop_linked(docs, k=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    ship(spark)
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text decoded from them."""
    ship(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# Forests, fingerprints and merges are not expressible in SQL; tests compare run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that its predecessor kept; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
