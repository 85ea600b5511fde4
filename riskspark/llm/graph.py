"""Small helpers on pairs: connected components and joins of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.session import materialize

#: Ids up to this number (16 bytes each) are sent to every executor; more are shuffled.
BROADCAST_IDS = 1_000_000


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of the nodes of edges ``a, b``.

    Alternates two steps on the edges until nothing changes: each node tells its larger
    neighbours, then its smaller ones, about the smallest of all. Rounds grow with the
    logarithm of the longest path; each is stored, so a lost executor costs little.
    """
    a, b = F.col("a"), F.col("b")
    now = materialize(_ordered(edges), "edges")
    digest = _digest(now)
    while True:
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b"))
        edges_large = _ordered(large)
        lowest = edges_large.groupBy("a").agg(F.min("b").alias("m"))
        small = edges_large.join(lowest, "a").select(
            F.when(b == F.col("m"), a).otherwise(b).alias("a"), F.col("m").alias("b")
        )
        now = materialize(_ordered(small), "edges")
        before, digest = digest, _digest(now)
        if digest == before:
            break
    return now.select(a.alias("node"), b.alias("component")).unionByName(
        now.select(b.alias("node"), b.alias("component")).distinct()
    )


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller one, without loops."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def with_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is among the stored ``ids`` (one column of that name, a long).

    The ids have a fixed width, so their number bounds what is broadcast; beyond the bound
    both sides are shuffled, with the same result.
    """
    return _by_ids(rows, ids, key, "left_semi")


def without_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is not among the stored ``ids``, nulls included."""
    return _by_ids(rows, ids, key, "left_anti")


def _by_ids(rows: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    ids = ids.select(F.col(key).alias("__listed_id"))
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, F.col(key) == F.col("__listed_id"), how)
