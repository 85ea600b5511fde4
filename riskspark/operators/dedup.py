"""Keep-first de-duplication of chunks and appends to a chunk table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col
KEY = ["source", "page", "text"]


def distinct_chunks(chunks: DataFrame) -> DataFrame:
    """The first arrival per (source, page, text); a missing page equals a missing page.

    The first arrival is found among digests and numbers of fixed width, by hash
    aggregation before the shuffle, so a text copied a billion times costs one row
    per task. The texts follow by its arrival, which is unique within a digest.
    """
    names = chunks.columns
    keyed = (
        chunks.withColumn("text", F.trim("text"))
        .where(c("text") != "")
        .withColumn("_key", F.unhex(content_digest()))
        .withColumn("_at", arrival())
    )
    first = keyed.groupBy("_key").agg(F.min("_at").alias("_at"))
    kept = keyed.join(first, ["_key", "_at"], "left_semi")
    # Rows that arrive as one (the same number and place) are one arrival.
    return kept.dropDuplicates(["_key", "_at"]).select(*names)


def arrival() -> Column:
    """Arrival and place of a chunk as one sortable number of fixed width."""
    seq = F.coalesce(c("ingest_seq"), F.lit(0)).cast("decimal(20,0)")
    place = F.coalesce(c("chunk_index"), F.lit(0)).cast("decimal(20,0)")
    return (seq * F.lit(1 << 24) + place).cast("decimal(38,0)")


def content_digest() -> Column:
    """SHA-256 of a chunk's key; the source length keeps the parts apart."""
    source = F.coalesce(c("source"), F.lit(""))
    page = F.coalesce(c("page").cast("string"), F.lit("-"))
    return F.sha2(F.concat_ws("|", F.length(source).cast("string"), source, page, c("text")), 256)


def new_chunks(arrived: DataFrame, stored: DataFrame) -> DataFrame:
    """Chunks of ``arrived`` whose key ``stored`` does not have, repeats removed.

    Only digests of the stored chunks are shuffled, not their texts.
    """
    return chunks_not_in(arrived, stored.select(content_digest().alias("digest"))).drop("digest")


def chunks_not_in(arrived: DataFrame, known: DataFrame) -> DataFrame:
    """The first arrivals whose ``digest`` is not among the known ones, with it."""
    fresh = distinct_chunks(arrived).withColumn("digest", content_digest())
    return fresh.join(known.distinct(), "digest", "left_anti")
