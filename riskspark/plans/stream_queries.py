"""Registered streaming queries: run to the end of the input, then read the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark.operators import rate_limit
from riskspark.session import scratch_path
from riskspark.sources import fixtures
from riskspark.streaming.ingest import ingest_stream, page_stream, stored_chunks
from riskspark.streaming.rate_limit import OUT, audit_stream, with_late
from riskspark.streaming.scoring import score_stream, site_stream

c = F.col
DAY, LIMIT = 24 * 3600, 2
DROPS = 3


def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving, sink, state = (scratch_path(spark, n) for n in ("sites-in", "scored", "state"))
    fixtures.sites(spark, sf_dir).write.parquet(arriving)
    score_stream(site_stream(spark, arriving), sink, state).awaitTermination()
    schema = f"site_id long, {S.TARGET} double, risk_level string, advisory string"
    return spark.read.schema(schema).parquet(sink)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops of documents and a repeat of the first, which adds nothing."""
    arriving, store, state = (scratch_path(spark, n) for n in ("pages-in", "store", "state"))
    pages = fixtures.page_texts(spark, sf_dir).withColumn("page", F.lit(None).cast("long"))
    for drop in (*range(DROPS), 0):
        part = pages.where(c("ingest_seq") % DROPS == drop)
        part.write.mode("append").parquet(arriving)
        ingest_stream(page_stream(spark, arriving), store, state).awaitTermination()
    return _contents(spark, store)


def _contents(spark: SparkSession, store: str) -> DataFrame:
    stored = stored_chunks(spark, store)
    return stored.select("chunk_id", "source", F.md5("text").alias("text_md5"))


def stream_ingest_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each drop comes by a stream with a checkpoint of its own; the store keeps all."""
    store = scratch_path(spark, "store")
    pages = fixtures.page_texts(spark, sf_dir).withColumn("page", F.lit(None).cast("long"))
    for drop in range(DROPS):
        arriving, state = scratch_path(spark, "pages-in"), scratch_path(spark, "state")
        pages.where(c("ingest_seq") % DROPS == drop).write.parquet(arriving)
        ingest_stream(page_stream(spark, arriving), store, state).awaitTermination()
    return _contents(spark, store)


def rate_limit_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fixtures.request_log(spark, sf_dir)
    return rate_limit.audit(log, DAY, F.lit(LIMIT).cast("long"))


def rate_limit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink, state = scratch_path(spark, "judged"), scratch_path(spark, "state")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    query = audit_stream(
        fixtures.as_request_log(events), sink, state, DAY, F.lit(LIMIT).cast("long"), "1 day"
    )
    query.awaitTermination()
    return spark.read.schema(OUT).parquet(sink)


def rate_limit_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th event comes when the watermark has long passed it, and is told so."""
    arriving, sink, state = (scratch_path(spark, n) for n in ("log-in", "judged", "state"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    newest = events.agg(F.max("ts") - F.expr("INTERVAL 2 DAYS")).first()[0]
    long_ago = c("ts") < F.lit(newest).cast("timestamp_ntz")
    marked = events.withColumn("is_late", (c("event_id") % 50 == 0) & long_ago)
    for late in (False, True):
        part = marked.where(c("is_late") == late).drop("is_late")
        part.write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(events.schema).parquet(arriving)
        audit_stream(
            fixtures.as_request_log(stream), sink, state, DAY, F.lit(LIMIT).cast("long"), "1 day"
        ).awaitTermination()
    judged = spark.read.schema(OUT).parquet(sink)
    return with_late(fixtures.request_log(spark, sf_dir), judged)
