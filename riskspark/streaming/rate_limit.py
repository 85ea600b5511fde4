"""The rate-limit audit as a stateful stream over buckets of (client, path) keys.

A call into Python costs milliseconds, so one call per key would outgrow the
judging itself; a bucket's keys share one call and one state row.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from riskspark import schema as S
from riskspark.operators.rate_limit import KEY, admit, counted_requests, limit_column

OUT = "request_id long, client string, path string, accepted boolean"
STATE = "client array<string>, path array<string>, recent array<array<long>>"
#: State of a checkpoint is kept by bucket, so this must not change under it.
BUCKETS = 2048


def with_late(log: DataFrame, judged: DataFrame, key: str = "request_id") -> DataFrame:
    """Every counted request with its verdict; the stream's late ones have none and say so.

    A stateful stream drops rows older than its watermark before any function sees
    them, so they are found by what the sink lacks.
    """
    requests = counted_requests(log).select(key, *KEY)
    return requests.join(judged.select(key, "accepted"), key, "left").withColumn(
        "reason", F.when(F.col("accepted").isNull(), "late")
    )


def _judge_bucket(rows: pd.DataFrame, window: int, recent: dict[tuple, list[int]]) -> pd.DataFrame:
    """Verdicts for the rows of many keys; ``recent`` holds sorted accepted times by key.

    It is updated and stays sorted.
    """
    which = rows.groupby(KEY, sort=False, dropna=False).ngroup().to_numpy()
    order = np.lexsort((rows["request_id"].to_numpy(), rows["us"].to_numpy(), which))
    rows, which = rows.iloc[order], which[order]
    edges = np.flatnonzero(np.diff(which, prepend=-1))
    names = rows[KEY].iloc[edges].astype(object)
    names = names.where(names.notna(), None).itertuples(index=False, name=None)
    us, limits = rows["us"].to_numpy(dtype=np.int64), rows["limit"].to_numpy()
    verdicts = np.empty(len(rows), dtype=bool)
    for name, a, b in zip(names, edges, [*edges[1:], len(rows)], strict=True):
        log, limit = recent.setdefault(name, []), int(limits[a])
        if log and us[a] < log[-1]:  # overtaken by an earlier batch
            overtaken = int(np.searchsorted(us[a:b], log[-1]))
            verdicts[a : a + overtaken] = admit(us[a : a + overtaken], limit, window, log)
            log.sort()
            a += overtaken
        verdicts[a:b] = admit(us[a:b], limit, window, log)
    return rows[["request_id", *KEY]].assign(accepted=verdicts)


def _expiries(recent: Mapping[tuple, list[int]], window: int) -> dict[tuple, int]:
    """The watermark in milliseconds beyond which a key's accepted times count no more."""
    return {k: times[-1] // 1000 + window // 1000 + 1 for k, times in recent.items() if times}


def audit_stream(
    log: DataFrame,
    sink: str,
    checkpoint: str,
    window_seconds: int = S.RATE_WINDOW_SECONDS,
    limit: Column | None = None,
    lateness: str = "1 minute",
) -> StreamingQuery:
    """Judge requests as they arrive; state per key is at most ``limit`` accepted times.

    Rows of a batch are judged in time order; a row of a later batch is judged
    on arrival, if it is not older than the watermark; ``with_late`` adds those that
    are. Keys are spread over ``BUCKETS`` buckets, each judged in one call. A key
    whose window the watermark has passed leaves the state when its bucket is next
    judged, or with the bucket's last key.
    """
    window = window_seconds * 1_000_000
    limits = limit_column() if limit is None else limit
    requests = (
        counted_requests(log.withWatermark("ts", lateness))
        .withColumn("limit", limits)
        .withColumn("bucket", F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS)).cast("int"))
        .select("bucket", "request_id", *KEY, "ts", "us", "limit")
    )

    def judge(
        bucket: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        recent: dict[tuple, list[int]] = {}
        if state.exists:
            clients, paths, times = state.get
            recent = dict(zip(zip(clients, paths, strict=True), map(list, times), strict=True))
        judged = None
        if not state.hasTimedOut:
            judged = _judge_bucket(pd.concat(list(batches)), window, recent)
        watermark = state.getCurrentWatermarkMs()
        live = {k: t for k, t in _expiries(recent, window).items() if t >= watermark}
        if live:
            clients, paths = map(list, zip(*live, strict=True))
            state.update((clients, paths, [recent[k] for k in live]))
            state.setTimeoutTimestamp(max(*live.values(), watermark + 1))
        elif state.exists:
            state.remove()
        if judged is not None:
            yield judged

    judged = requests.groupBy("bucket").applyInPandasWithState(
        judge, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return (
        judged.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
