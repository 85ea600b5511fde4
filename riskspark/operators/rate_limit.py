"""Sliding-log rate limiting over a request log, split across tasks by time.

A request is accepted when fewer than ``limit`` accepted requests of its
(client, path) lie in the window before it. Each verdict depends on earlier
verdicts, so a key is a sequence; a busy key may still span many tasks.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark.session import checkpointed

c = F.col
KEY = ["client", "path"]


def limit_column(
    limits: Mapping[str, int] = S.RATE_LIMIT_BY_PATH, default: int = S.RATE_LIMIT
) -> Column:
    expr = F.lit(default)
    for path, limit in limits.items():
        expr = F.when(c("path") == path, limit).otherwise(expr)
    return expr.cast("long")


def counted_requests(log: DataFrame) -> DataFrame:
    """Requests that count towards a limit, with time in microseconds."""
    exempt = c("method").isin(*S.RATE_EXEMPT_METHODS) | c("path").isin(*S.RATE_EXEMPT_PATHS)
    return log.where(~exempt).withColumn("us", F.unix_micros("ts"))


def admit(times: np.ndarray, limit: int, window: int, recent: list[int]) -> np.ndarray:
    """Verdicts for sorted times of one key; ``recent`` holds accepted times and is updated."""
    joined = np.concatenate([np.array(recent, dtype=np.int64), times])
    spaced = joined[limit:] - joined[: max(len(joined) - limit, 0)] > window
    if spaced[max(len(recent) - limit, 0) :].all():  # never crowded: all accepted
        recent[:] = joined[-limit:].tolist()
        return np.ones(len(times), dtype=bool)
    log = deque(recent)
    verdicts = np.empty(len(times), dtype=bool)
    for i, now in enumerate(times.tolist()):
        while log and log[0] < now - window:
            log.popleft()
        verdicts[i] = len(log) < limit
        if verdicts[i]:
            log.append(now)
    recent[:] = log
    return verdicts


def _walk(batches: Iterator[pd.DataFrame], window: int, carried: Mapping[int, tuple]):
    """Judge one sorted partition: yields (batch, verdicts, (partition, key, accepted times))."""
    part, key, recent = None, None, []
    for batch in batches:
        if batch.empty:
            continue
        if part is None:
            part = int(batch["_part"].iloc[0])
            key, start = carried.get(part, (None, []))
            recent = list(start)
        names = batch[KEY]
        edges = np.flatnonzero((names != names.shift()).any(axis=1).to_numpy())
        us, limits = batch["us"].to_numpy(), batch["limit"].to_numpy()
        verdicts = np.empty(len(batch), dtype=bool)
        for a, b in zip(edges, [*edges[1:], len(batch)], strict=True):
            mine = tuple(names.iloc[a])
            if mine != key:
                key, recent = mine, []
            verdicts[a:b] = admit(us[a:b], int(limits[a]), window, recent)
        yield batch, verdicts, (part, key, recent)


_ENDS = (
    "part long, first_client string, first_path string, first_us long, "
    "client string, path string, recent array<long>"
)


def _partition_ends(placed: DataFrame, window: int, carried: Mapping[int, tuple]) -> list:
    """One row per partition: its first request, last key and that key's accepted times."""

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, last = None, None
        for batch, _, state in _walk(batches, window, carried):
            first = first if last else (*batch[KEY].iloc[0], int(batch["us"].iloc[0]))
            last = state
        if last:
            part, key, recent = last
            columns = [n.split()[0] for n in _ENDS.split(", ")]
            yield pd.DataFrame([(part, *first, *key, recent)], columns=columns)

    return placed.mapInPandas(ends, _ENDS).collect()


def _settle(placed: DataFrame, window: int) -> dict[int, tuple]:
    """What each partition inherits from the one before, iterated until it stays the same."""
    carried: dict[int, tuple] = {}
    ends = {r["part"]: r for r in _partition_ends(placed, window, carried)}
    while True:
        changed = {}
        for before, after in zip(sorted(ends), sorted(ends)[1:], strict=False):
            key = (ends[before]["client"], ends[before]["path"])
            following = ends[after]
            if key != (following["first_client"], following["first_path"]):
                continue
            recent = [t for t in ends[before]["recent"] if t >= following["first_us"] - window]
            if (key, recent) != carried.get(after, (key, [])):
                changed[after] = (key, recent)
        if not changed:
            return carried
        carried |= changed
        touched = placed.where(c("_part").isin(*changed))
        ends |= {r["part"]: r for r in _partition_ends(touched, window, carried)}


def audit(
    log: DataFrame,
    window_seconds: int = S.RATE_WINDOW_SECONDS,
    limit: Column | None = None,
    key: str = "request_id",
) -> DataFrame:
    """``key, client, path, accepted`` for every counted request.

    The log is range-sorted by client, path and time, and the partitions are
    judged side by side. What one hands to the next, the accepted times of
    its last key, is passed on until nothing changes. Runs from different
    starts soon agree, so few rounds are needed, and a round only looks at
    partitions a busy key crosses.
    """
    window = window_seconds * 1_000_000
    limits = limit_column() if limit is None else limit
    rows = counted_requests(log).select(key, *KEY, "us", limits.alias("limit"))
    order = [*KEY, "us", key]
    placed = checkpointed(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
    )
    carried = _settle(placed, window)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, verdicts, _ in _walk(batches, window, carried):
            yield batch[[key, *KEY]].assign(accepted=verdicts)

    id_type = rows.schema[key].dataType.simpleString()
    return placed.mapInPandas(
        judge, f"{key} {id_type}, client string, path string, accepted boolean"
    )
