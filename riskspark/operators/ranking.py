"""Global ranks, exact splits and top-k without a single-task sort."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark.session import materialize

c = F.col
HASH_WIDTH = 32  # characters of an MD5 digest
_PARTITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def range_sorted(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """``df`` in global order, written once, with partition ``_part`` and place ``_pos``.

    The order must be total. Range partitioning splits a key that holds many
    rows as long as later order columns tell its rows apart.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stamped = ordered.withColumn("_mid", F.monotonically_increasing_id())
    stored = materialize(stamped, name)
    return stored.select(
        "*",
        F.shiftright("_mid", _PARTITION_BITS).alias("_part"),
        c("_mid").bitwiseAND((1 << _PARTITION_BITS) - 1).alias("_pos"),
    ).drop("_mid")


def global_rank(
    df: DataFrame, order: Sequence[Column | str], rank: str = "rank", total: str | None = None
) -> DataFrame:
    """Add the 0-based rank of each row in a total order (and the row count).

    One range shuffle; the only unpartitioned window runs over one row per
    partition, and so does the broadcast.
    """
    placed = range_sorted(df, order, "rank")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    ranked = placed.join(F.broadcast(offsets), "_part").withColumn(rank, c("_offset") + c("_pos"))
    if total:
        ranked = ranked.withColumn(total, c("_total"))
    return ranked.drop("_part", "_pos", "_offset", "_total")


def shuffle_hash(key: str, seed: int) -> Column:
    """A seeded hash that orders rows alike however they are partitioned."""
    return F.md5(F.concat_ws("|", c(key).cast("string"), F.lit(str(seed))))


def hash_cutoffs(
    df: DataFrame, key: str, seed: int, ranks: Sequence[int], leaf_rows: int = 100_000
) -> list[tuple[str, Any]]:
    """The (hash, key) of the rows at the given 0-based ranks in hash order.

    Ranks are narrowed down by counting hash prefixes, so nothing is sorted
    or shuffled but a few thousand counts per pass, and three passes reach
    any row of a trillion. Rows of equal key share a hash of full width and are
    counted, not listed. ``df`` should be a stored table without null keys.
    """
    if not df.where(c(key).isNull()).isEmpty():
        raise ValueError(f"{key!r} has null values, which have no place in hash order")
    hashed = df.select(key, shuffle_hash(key, seed).alias("_h"))
    open_ranks = {rank: ("", rank) for rank in ranks}  # rank -> (prefix, rank below prefix)
    small: dict[str, int] = {}
    width = 0
    while any(prefix not in small for prefix, _ in open_ranks.values()):
        width += 3
        prefixes = {prefix for prefix, _ in open_ranks.values() if prefix not in small}
        level = hashed.where(c("_h").substr(1, width - 3).isin(*prefixes))
        counted = level.groupBy(c("_h").substr(1, width).alias("p")).count().collect()
        by_parent: dict[str, list] = {}
        for row in sorted(counted, key=lambda r: r["p"]):
            by_parent.setdefault(row["p"][: width - 3], []).append((row["p"], row["count"]))
        for rank, (prefix, below) in open_ranks.items():
            if prefix in small:
                continue
            for child, n in by_parent[prefix]:
                if below < n:
                    open_ranks[rank] = (child, below)
                    if n <= leaf_rows or width >= HASH_WIDTH:
                        small[child] = n
                    break
                below -= n
    found: dict[str, list] = {}
    for size in sorted({len(p) for p in small}):
        wanted = [p for p in small if len(p) == size]
        leaf = hashed.where(c("_h").substr(1, size).isin(*wanted))
        for row in leaf.groupBy("_h", key).count().collect():
            found.setdefault(row["_h"][:size], []).append(((row["_h"], row[key]), row["count"]))
    return [_at(sorted(found[prefix]), below) for prefix, below in (open_ranks[r] for r in ranks)]


def _at(counted: list[tuple], rank: int) -> tuple[str, Any]:
    """The entry of a counted, sorted list that covers a 0-based rank."""
    for entry, n in counted:
        if rank < n:
            return entry
        rank -= n
    raise IndexError("the rank is beyond the list")


def _after(key: str, seed: int, cutoff: tuple[str, Any]) -> Column:
    """Whether a row comes at or after a cutoff in hash order."""
    h = shuffle_hash(key, seed)
    return (h > cutoff[0]) | ((h == cutoff[0]) & (c(key) >= cutoff[1]))


def holdout_split(
    df: DataFrame, key: str, share: float = S.TEST_SHARE, seed: int = S.SEED
) -> DataFrame:
    """Add ``is_test``: exactly ceil(share * rows) rows, the first in hash order.

    ``df`` should be a stored table with a unique key.
    """
    rows = df.count()
    n_test = math.ceil(rows * share)
    if n_test in (0, rows):
        return df.withColumn("is_test", F.lit(n_test > 0))
    (cutoff,) = hash_cutoffs(df, key, seed, [n_test])
    return df.withColumn("is_test", ~_after(key, seed, cutoff))


def shuffled_folds(
    df: DataFrame, key: str, splits: int = S.CV_SPLITS, seed: int = S.SEED
) -> DataFrame:
    """Add ``fold``: min(splits, rows) even folds in hash order, the first ones one row larger.

    ``df`` should be a stored table with a unique key.
    """
    rows = df.count()
    splits = min(splits, rows)
    base, extra = divmod(rows, splits)
    starts = [fold * base + min(fold, extra) for fold in range(1, splits)]
    fold = F.lit(0)
    for cutoff in hash_cutoffs(df, key, seed, starts):
        fold = fold + _after(key, seed, cutoff).cast("int")
    return df.withColumn("fold", fold)


def at_least_top(df: DataFrame, measure: str, k: int) -> DataFrame:
    """Rows whose whole-number ``measure`` is among the ``k`` largest, ties included.

    The cut-off comes from the histogram of the measure; a histogram of N
    counts that sum up to M has at most sqrt(2 M) entries.
    """
    histogram = df.groupBy(measure).agg(F.count("*").alias("_n"))
    above = Window.orderBy(c(measure).desc()).rowsBetween(Window.unboundedPreceding, -1)
    reached = histogram.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0)))
    cutoff = reached.where(c("_above") < k).agg(F.min(measure).alias("cutoff"))
    return df.where(c(measure) >= cutoff.scalar())


def top_rows(df: DataFrame, order: Sequence[Column], k: int, key: str) -> DataFrame:
    """The first ``k`` rows in a total order.

    Buckets of ``key``, as many as there are shuffle partitions, are cut to ``k``
    first, so the last step sees at most that many times ``k`` rows.
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_bucket = Window.partitionBy("_bucket").orderBy(*order)
    cut = (
        df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
        .withColumn("_n", F.row_number().over(per_bucket))
        .where(c("_n") <= k)
    )
    return cut.drop("_bucket", "_n").orderBy(*order).limit(k)


def rank_within(df: DataFrame, group: str, order: Sequence[Column], k: int) -> DataFrame:
    """Top ``k`` rows per group with 1-based ``rank``; Spark cuts groups before the shuffle."""
    window = Window.partitionBy(group).orderBy(*order)
    ranked = df.withColumn("rank", F.row_number().over(window)).where(c("rank") <= k)
    return ranked.withColumn("rank", c("rank").cast("long"))
