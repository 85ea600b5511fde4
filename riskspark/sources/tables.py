"""Table scans and the schema tests that need no data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import schema as S


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_scan(df: DataFrame) -> DataFrame:
    """Use all cores on a table scan of few splits; a scan of many is left alone.

    Only for plain scans, whose splits are known without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def csv_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row, every column as text; a missing path is an error.

    Types come later from numeric coercion, which treats every spelling of a
    missing value alike, so no second scan is spent on type inference.
    """
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def page_table(df: DataFrame, source: str = "source", page: str = "page", text: str = "text"):
    """Page texts as ``source, page, text`` with missing text as empty."""
    others = [n for n in df.columns if n not in (source, page, text)]
    return df.select(
        *others,
        F.col(source).alias("source"),
        F.col(page).cast("long").alias("page"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def missing_columns(df: DataFrame, required) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def covers(df: DataFrame, feature_set: str, target: str = S.REAL_TARGET) -> bool:
    return not missing_columns(df, {*S.feature_columns(feature_set), target})


def upload_listing(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` as ``name, size``; file content is never read.

    Spark lists no empty files, so those are never offered for admission.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.col("length").alias("size")
    )
