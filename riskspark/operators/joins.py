"""Joins of site tables: by record id, by position, and skew-safe lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark.operators.ranking import global_rank
from riskspark.sources.tables import covers, require_columns

c = F.col
BROADCAST_ROWS = 200_000
HOT_SHARE = 1_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table of narrow rows is small; reads no more rows than asked for."""
    return df.limit(rows + 1).count() <= rows


def is_unique(df: DataFrame, key: str) -> bool:
    return df.groupBy(key).count().where(c("count") > 1).isEmpty()


def keyed_merge(left: DataFrame, right: DataFrame, key: str = S.RECORD_ID) -> DataFrame:
    """Inner join on a key unique on both sides; clashing right columns get a suffix."""
    for side in (left, right):
        require_columns(side, [key])
        if not is_unique(side, key):
            raise ValueError(f"{key!r} is not unique")
    renames = {n: f"{n}_nuclide" for n in right.columns if n in left.columns and n != key}
    return left.join(right.withColumnsRenamed(renames), key)


def positional_zip(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[Column | str],
    right_order: Sequence[Column | str],
) -> DataFrame:
    """Rows side by side by place in the given orders; the left wins on equal names.

    Tables of unequal length have no such pairing and are an error.
    """
    lengths = left.count(), right.count()
    if lengths[0] != lengths[1]:
        raise ValueError(f"tables of {lengths[0]} and {lengths[1]} rows can't be zipped")
    right = right.drop(*(set(left.columns) & set(right.columns)))
    a = global_rank(left, left_order, "_place")
    b = global_rank(right, right_order, "_place")
    return a.join(b, "_place").drop("_place")


def training_table(
    env: DataFrame,
    nuclides: DataFrame,
    feature_set: str = S.DEFAULT_FEATURE_SET,
    target: str = S.REAL_TARGET,
    env_order: Sequence[str] = (),
    nuclide_order: Sequence[str] = (),
    key: str = S.RECORD_ID,
) -> DataFrame:
    """The table that has all columns of a feature set, or the two merged.

    The choice looks at schemas only. Tables of equal length are zipped when
    the caller names an order for both, since Spark rows have none; otherwise
    they are joined on a unique record id.
    """
    needed = {*S.feature_columns(feature_set), target}
    for table in (nuclides, env):
        if covers(table, feature_set, target):
            return table
    if env_order and nuclide_order and env.count() == nuclides.count():
        merged = positional_zip(env, nuclides, env_order, nuclide_order)
    elif key in env.columns and key in nuclides.columns:
        merged = keyed_merge(env, nuclides, key)
    else:
        raise ValueError(
            "the tables need all feature columns, a common row order or a unique record id"
        )
    return require_columns(merged, needed)


def lookup_join(
    big: DataFrame, table: DataFrame, key: str, weight: str, rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add the columns of ``table`` (unique ``key``) to ``big``.

    ``weight`` is how many rows of ``big`` share the key. A small table is
    broadcast. Otherwise keys with more than 1/1000 of all rows, at most 1000
    of them, are broadcast and the rest is joined by shuffle, so no task gets
    a hot key's rows.
    """
    plain = table.drop(weight)
    if fits_broadcast(table, rows):
        return big.join(F.broadcast(plain), key)
    total = table.agg(F.sum(weight)).first()[0]
    is_hot = c(weight) * HOT_SHARE > total
    hot = table.where(is_hot).drop(weight)
    hot_keys = F.broadcast(hot.select(key))
    served = big.join(F.broadcast(hot), key)
    rest = big.join(hot_keys, key, "left_anti").join(table.where(~is_hot).drop(weight), key)
    return served.unionByName(rest)
