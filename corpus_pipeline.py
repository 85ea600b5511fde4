"""The corpus pipeline: raw documents to a training mixture, in stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import decontaminate, mixing, near, quality, repeats
from riskspark.llm.runtime import prepare
from riskspark.session import materialize
from riskspark.sources.tables import parquet_table

#: Executors keep their heap from stage to stage, so Python tasks get less at once than in a query.
BATCH = "4m"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rule_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their frequent lines.

    Null texts are rejected, repeated rows are judged alike, an empty table stays empty.
    """
    prepare(spark, BATCH)
    return quality.clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    prepare(spark, BATCH)
    return near.clean_documents(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that an earlier document holds too are cut out."""
    prepare(spark, BATCH)
    return repeats.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with the benchmark go."""
    prepare(spark, BATCH)
    return decontaminate.clean_documents(docs, parquet_table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The draws of the mixture, by document, epoch and block."""
    prepare(spark, BATCH)
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", rule_quality),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("mixing", source_mixing),
]

#: No SQL can express the stages; the tests compare them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each to the stored result of the one before."""
    docs = parquet_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
