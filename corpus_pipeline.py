"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on the whole table its predecessor left, written as Parquet and
read again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from snapdelta.llm import near_dedup, packing, quality_classifier, quality_rules, substring_dedup
from snapdelta.llm.common import Stages, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are no outlier in their language and source."""
    ship(spark)
    return quality_rules.keep_good(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier takes for good. It learns from the labelled rows of
    ``documents``: few bad ones are left after the rules, but it has to know them."""
    ship(spark)
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_classifier.keep_good(docs, labelled, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    ship(spark)
    return near_dedup.deduplicated(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that occur more than once."""
    ship(spark)
    return substring_dedup.deduplicated(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents left and its place in a training sequence."""
    ship(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("near dedup", near_dedup_stage),
    ("substring dedup", substring_dedup_stage),
    ("packing", packing_stage),
]
#: Learned weights and robust estimates have no SQL; tests hold every stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stages.write(stage(spark, docs, sf_dir), f"pipeline-{i}-{name.replace(' ', '-')}", keep=True)
    return docs
