"""Sharding by rendezvous hashing of stable record keys.

Every shard bids ``ln(u) / weight`` for a record, with ``u`` in (0, 1] taken from the MD5 digest of
key and shard; the highest bid has the record, so a shard gets its weight's share of the keys. Bids
of the other shards don't change when a shard is added, so rows move into the new one only, and when
a shard goes, only its rows move. Keys and weights decide, not order, partitions or other rows.

Slots number the rows of a shard without gaps, by key, checksum and size. They come from one range
sort of narrow rows with offsets per partition, so a shard of any size, and a key with any number
of rows, is spread over many tasks. Spark's own functions do all of it.

Defined cases: a null key is the empty string; rows that share a key share a shard; repeated rows
have a slot each; a null text has no bytes; other columns are ignored by ``number`` and kept by
``write_shards``, where columns ``shard`` and ``slot`` of the input are replaced; an empty table gives an
empty result and an empty folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.checksums import crc32_sql
from riskspark.llm.expressions import let, whole
from riskspark.operators.ranking import global_rank
from riskspark.session import materialize

#: Hexadecimal digits of a digest that make a bid: 52 bits, exact in a double.
_DIGITS = 13
#: Bytes a record takes besides its text.
RECORD_BYTES = 16


@dataclass(frozen=True)
class Shards:
    """Weights of the shards, numbered from 0, and of those that a larger layout adds."""

    weights: tuple[float, ...] = (1.0,) * 40
    more: tuple[float, ...] = (1.0,)

    def __post_init__(self) -> None:
        if not self.weights or min((*self.weights, *self.more)) <= 0:
            raise ValueError("shards need weights above zero, and there must be one at least")


def _bids(key: Column, weights: tuple[float, ...]) -> Column:
    """An array of (bid, minus shard), one entry for each weight; ties go to the first shard."""
    shards = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in enumerate(weights)))

    def bid(shard: Column) -> Column:
        digest = F.md5(F.concat(key, F.lit(":"), shard["i"].cast("string")))
        number = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long")
        u = (number + 1).cast("double") / float(16**_DIGITS)
        return F.struct((F.log(u) / shard["w"]).alias("bid"), (-shard["i"]).alias("i"))

    return F.transform(shards, bid)


def placement(key: Column, shards: Shards) -> Column:
    """Struct of ``shard`` and ``grown_shard`` (with the added shards too; null without any)."""
    n, total = len(shards.weights), len(shards.weights) + len(shards.more)
    name = F.coalesce(key.cast("string"), F.lit(""))

    def chosen(bids: Column) -> Column:
        grown = -F.array_max(bids)["i"] if total > n else F.lit(None)
        return F.struct(
            (-F.array_max(F.slice(bids, 1, n))["i"]).cast("int").alias("shard"),
            grown.cast("int").alias("grown_shard"),
        )

    return let(_bids(name, shards.weights + shards.more), chosen)


def _sized(docs: DataFrame) -> DataFrame:
    text = whole("text")
    size = F.octet_length(text).cast("long") + RECORD_BYTES
    checksum = F.crc32(text.cast("binary"))
    return docs.select("doc_id", size.alias("size"), checksum.alias("text_crc32"))


def number(docs: DataFrame, shards: Shards = Shards()) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row."""
    placed = _sized(docs).select("*", placement(F.col("doc_id"), shards).alias("at"))
    stored = materialize(
        placed.select(
            "doc_id", "size", "text_crc32", "at.shard", "at.grown_shard",
            F.monotonically_increasing_id().alias("row"),
        ),
        "shards",
    )
    ranked = global_rank(stored, ["shard", "doc_id", "text_crc32", "size", "row"], "place")
    sizes = stored.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))  # a row for each shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return ranked.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("place") - F.col("start")).cast("long").alias("slot"), "grown_shard",
    )


def manifest(numbered: DataFrame) -> DataFrame:
    """Rows, bytes, a checksum that doesn't depend on order, and rows to move, for each shard."""
    return numbered.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("size").alias("n_bytes"),
        F.bit_xor(F.xxhash64("doc_id", "text_crc32")).alias("checksum"),
        F.count_if(F.col("grown_shard") != F.col("shard")).alias("n_moving"),
    )


def write_shards(
    docs: DataFrame, folder: str, key: str = "doc_id", shards: Shards = Shards(), rows_per_file: int = 1_000_000
) -> None:
    """Write whole rows to ``folder/shard=N``, in files of ``rows_per_file`` rows at most.

    A shard's rows are range-partitioned by a hash of key and place in the input, so a large
    shard or key takes many tasks.
    """
    place = F.xxhash64(F.col(key).cast("string"), F.monotonically_increasing_id())
    placed = docs.withColumn("shard", placement(F.col(key), shards)["shard"]).drop("slot")
    dealt = placed.withColumn("__place", place).repartitionByRange("shard", "__place").drop("__place")
    writer = dealt.write.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy("shard").parquet(folder)


def oracle_sql(shards: int = 40) -> str:
    """Every bid of every key; slots by one window for each shard."""
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, CAST(octet_length(encode(t)) AS BIGINT) + {RECORD_BYTES} AS size,
        CAST({crc32_sql('t')} AS BIGINT) AS text_crc32 FROM d),
k AS (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM d),
b AS (SELECT k, CAST(i AS INTEGER) AS i,
        ln((CAST('0x' || substr(md5(k || ':' || i), 1, {_DIGITS}) AS BIGINT) + 1) / {16**_DIGITS}.0) AS bid
      FROM k, range({shards} + 1) r(i)),
p AS (SELECT k, arg_max(i, bid) FILTER (i < {shards}) AS shard, arg_max(i, bid) AS grown_shard
      FROM b GROUP BY k)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
  grown_shard
FROM s JOIN p ON p.k = coalesce(CAST(s.doc_id AS VARCHAR), '')
"""
