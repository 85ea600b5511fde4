"""Stateless stream scoring: the batch expressions over arriving site records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskspark import schema as S
from riskspark.functions.features import equation_scorer
from riskspark.functions.risk import classify
from riskspark.operators.scenarios import Scorer


def site_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int = 1000
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(S.SITE_SCHEMA)
    return reader.option("maxFilesPerTrigger", files_per_trigger).load(path)


def score_stream(
    sites: DataFrame, sink: str, checkpoint: str, scorer: Scorer = equation_scorer
) -> StreamingQuery:
    """Score what has arrived and stop; restarts go on from the checkpoint."""
    scored = classify(scorer(sites)).select("site_id", S.TARGET, "risk_level", "advisory")
    writer = scored.writeStream.format("parquet").option("path", sink)
    return (
        writer.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
