"""Incremental document ingestion: chunk, drop known chunks, append, index."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskspark import schema as S
from riskspark.operators.chunking import identified_chunks
from riskspark.operators.dedup import chunks_not_in
from riskspark.operators.search import Index
from riskspark.operators.tfidf import term_counts, vocabulary, weights_of_counts
from riskspark.sources.tables import spread_scan

DROP_SCHEMA = T.StructType([T.StructField("ingest_seq", T.LongType()), *S.PAGE_SCHEMA])
CHUNK_SCHEMA = "chunk_id string, ingest_seq long, source string, page long, " \
    "chunk_index long, text string"
STORED_SCHEMA = f"{CHUNK_SCHEMA}, digest string"
TERM_SCHEMA = "chunk_id string, term string, tf long"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that runs append to batch by batch; empty if it is not there yet."""
    try:
        return spark.read.schema(f"{schema}, run string, batch long").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, run string, batch long")


def page_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(DROP_SCHEMA)
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def ingest_stream(pages: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Append the new chunks of each batch and their term counts below ``store``.

    A batch writes its own partition, named by the id of the stream's checkpoint and
    the number of the batch, so replaying it after a failure changes nothing and a
    stream with another checkpoint adds to the store. Only the digests of what is
    stored are read to find the new chunks, and only these are tokenised; document
    frequencies follow from the stored counts when the index is opened. One stream
    at a time should write to a store.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"run={run}/batch={batch_id}"
        arrived = identified_chunks(spread_scan(batch))
        before = _stored(spark, f"{store}/chunks", STORED_SCHEMA).where(
            (F.col("run") != run) | (F.col("batch") != batch_id)
        )
        new = chunks_not_in(arrived, before.select("digest"))
        columns = ("chunk_id", "ingest_seq", "source", "page", "chunk_index", "text", "digest")
        new.select(*columns).write.mode("overwrite").parquet(f"{store}/chunks/{place}")
        written = spark.read.schema(CHUNK_SCHEMA).parquet(f"{store}/chunks/{place}")
        term_counts(written).write.mode("overwrite").parquet(f"{store}/terms/{place}")

    return (
        pages.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_chunks(spark: SparkSession, store: str) -> DataFrame:
    """All chunks below ``store``."""
    return _stored(spark, f"{store}/chunks", CHUNK_SCHEMA).drop("run", "batch")


def open_index(spark: SparkSession, store: str, max_terms: int = S.MAX_TERMS) -> Index:
    """The index over everything ingested so far; weights reflect all documents."""
    chunks = stored_chunks(spark, store)
    counts = _stored(spark, f"{store}/terms", TERM_SCHEMA).drop("run", "batch")
    vocab = vocabulary(counts, chunks.count(), max_terms)
    return Index(chunks, vocab, weights_of_counts(counts, vocab))
