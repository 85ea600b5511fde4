"""Exact removal of repeated byte strings by prefix doubling over chosen positions.

Sorting every byte position would shuffle many times the text. Positions are chosen by content
instead: every string of ``length`` bytes has one anchor, the place of the smallest hash among its
``seed``-byte strings, so equal strings have equal anchors. Strings with the same anchor follow one
another and form a run. Three rounds, each a sort by Spark of pairs of what is known of a position
and what stands at a growing offset:

1. (rank of the seed, rank of the run's whole string): runs that a smaller document holds entirely
   are removed entirely; runs whose seed is unique can't repeat and are dropped;
2. the other runs are sent once, as bytes, to the task of their seed;
3. (rank of the seed, rank of the string of ``length`` bytes) within that task, for each start in
   the run, past the threshold: a start that a smaller document has too is removed.

A rank is a 64-bit hash; two different strings count as equal only if two such hashes collide. In
each round, rows stream through sorted partitions, so a seed that a third of all documents hold is
never held in memory; within a part of a scan, its repetitions are marked before the shuffle.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing; a row without a
doc_id loses nothing and removes nothing; rows that share a doc_id are copies of one document, never
of each other; an empty table gives an empty result; other columns pass through ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import textbytes as tb
from riskspark.llm.runtime import released
from riskspark.session import materialize

_LOW = np.uint64(0xFFFFFFFF)
_ORDER = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class RepeatRules:
    """Shortest repeated string and length of the seeds, in bytes."""

    length: int = 50
    seed: int = 24

    def __post_init__(self):
        if not 0 < self.seed <= self.length:
            raise ValueError("a seed is at most as long as the shortest repeated string")


@dataclass
class Runs:
    """Starts ``low`` to ``high`` with one anchor each, the rank of seed and of the whole."""

    low: np.ndarray
    high: np.ndarray
    seed: np.ndarray
    whole: np.ndarray
    text: np.ndarray


def runs_of(data: np.ndarray, at: np.ndarray, rules: RepeatRules) -> Runs:
    """The runs of all texts of a part, in order; ``text`` is the number of the text."""
    none = np.zeros(0, dtype=np.int64)
    starts = len(data) - rules.length + 1
    if starts <= 0:
        return Runs(none, none, none.astype(np.uint64), none.astype(np.uint64), none)
    sums, down = tb.prefix_hash(data)
    seeds = len(data) - rules.seed + 1
    raw = (sums[rules.seed :] - sums[:seeds]) * down[:seeds]
    order = (((raw ^ (raw >> np.uint64(29))) * _ORDER) & ~_LOW) | np.arange(seeds, dtype=np.uint64)
    anchor = (_window_minimum(order, rules.length - rules.seed + 1) & _LOW).astype(np.int64)
    # Starts near the end of a text would reach into the next one.
    tail = np.zeros(starts + rules.length + 1, dtype=np.int32)
    np.add.at(tail, np.minimum(np.maximum(at[1:] - rules.length + 1, at[:-1]), starts), 1)
    np.add.at(tail, np.minimum(at[1:], starts), -1)
    place = np.flatnonzero(np.cumsum(tail[:starts]) == 0)
    if not len(place):
        return Runs(none, none, none.astype(np.uint64), none.astype(np.uint64), none)
    anchor = anchor[place]
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    low, high, seat = place[first], place[last], anchor[first]
    whole = tb.range_hash(sums, down, low, high + rules.length)
    whole = tb.mix(whole + (seat - low).astype(np.uint64) * _ORDER)
    text = np.searchsorted(at, low, side="right") - 1
    return Runs(low, high, tb.mix(raw[seat]), whole, text)


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima of blocks both ways."""
    if width == 1:
        return values
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _groups(batches) -> Iterator[pa.RecordBatch]:
    """Neighbouring small parts of the texts as one, to find repetitions before the shuffle."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= 8 << 20:
            yield _one(held)
            held, size = [], 0
    if held:
        yield _one(held)


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    batches = pa.Table.from_batches(held).combine_chunks().to_batches()
    return batches[0] if batches else held[0]


_PART = 1 << 18


def _seed_rows(docs: DataFrame, rules: RepeatRules) -> DataFrame:
    """``seed, whole, doc, known`` of the different runs of each document.

    A run that an earlier document of the same group holds is known to be covered; it takes
    a place of its own in the shuffle instead of that of its seed.
    """

    def run(batches):
        for batch in _groups(batches):
            seed, whole, doc = [], [], []
            for part in tb.slices(batch, "text", _PART):
                data, at = tb.flat(part.column("text"))
                found = runs_of(data, at, rules)
                ids = part.column("doc_id").to_numpy()
                seed.append(found.seed)
                whole.append(found.whole)
                doc.append(ids[found.text])
            if not seed:
                continue
            seed, whole, doc = (np.concatenate(x) for x in (seed, whole, doc))
            order = np.lexsort((doc, whole, seed))
            seed, whole, doc = seed[order], whole[order], doc[order]
            same = np.zeros(len(seed), dtype=bool)
            same[1:] = (seed[1:] == seed[:-1]) & (whole[1:] == whole[:-1])
            again = same.copy()
            again[1:] &= doc[1:] == doc[:-1]
            leader = np.maximum.accumulate(np.where(same, 0, np.arange(len(seed))))
            known = same & (doc > doc[leader]) if len(seed) else same
            seed = np.where(known, tb.mix(whole ^ doc.view(np.uint64)), seed)
            left = ~again
            yield pa.RecordBatch.from_arrays(
                [_signed(seed[left]), _signed(whole[left]), pa.array(doc[left]), pa.array(known[left])],
                names=["seed", "whole", "doc", "known"],
            )

    return docs.where("doc_id is not null").mapInArrow(
        released(run), "seed long, whole long, doc long, known boolean"
    )


def _marks(rows: DataFrame) -> DataFrame:
    """``doc, whole, open``: covered runs, and the smallest holders of runs of shared seeds."""

    def run(batches):
        last_seed = last_whole = holder = None  # of the row before
        waiting = None  # the only run of the last seed so far
        for batch in batches:
            known = batch.column("known").to_numpy(zero_copy_only=False)
            seed, whole, doc = (batch.column(c).to_numpy() for c in ("seed", "whole", "doc"))
            out_doc, out_whole, out_open = [doc[known]], [whole[known]], [np.zeros(known.sum(), bool)]
            seed, whole, doc = seed[~known], whole[~known], doc[~known]
            if len(seed):
                new_seed = np.r_[last_seed is None or seed[0] != last_seed, seed[1:] != seed[:-1]]
                new_run = new_seed | np.r_[
                    last_whole is None or whole[0] != last_whole, whole[1:] != whole[:-1]
                ]
                first = np.maximum.accumulate(np.where(new_run, np.arange(len(seed)), -1))
                smallest = np.where(first >= 0, doc[first], holder if holder is not None else 0)
                covered = ~new_run & (doc > smallest)
                out_doc.append(doc[covered])
                out_whole.append(whole[covered])
                out_open.append(np.zeros(covered.sum(), bool))

                at = np.flatnonzero(new_run)
                # Runs of a seed: the first of the batch may go on with the seed before.
                number = np.cumsum(new_seed[at]) if len(at) else at
                goes_on = len(at) > 0 and not new_seed[at[0]]
                shared = np.zeros(len(at), dtype=bool)
                if len(at):
                    counts = np.bincount(number)
                    shared = counts[number] > 1
                    if goes_on:
                        shared |= number == 0
                        if waiting is not None:
                            out_whole.append(np.array([waiting[0]]))
                            out_doc.append(np.array([waiting[1]]))
                            out_open.append(np.array([True]))
                            waiting = None
                    out_doc.append(doc[at[shared]])
                    out_whole.append(whole[at[shared]])
                    out_open.append(np.ones(shared.sum(), bool))
                    if not shared[-1]:
                        waiting = (whole[at[-1]], doc[at[-1]])
                    elif number[-1] != 0 or goes_on:
                        waiting = None
                last_seed, last_whole, holder = seed[-1], whole[-1], smallest[-1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(out_doc).astype(np.int64)),
                    pa.array(np.concatenate(out_whole).astype(np.int64)),
                    pa.array(np.concatenate(out_open)),
                ],
                names=["doc", "whole", "open"],
            )

    return rows.mapInArrow(released(run), "doc long, whole long, open boolean")


def _contexts(texts: DataFrame, rules: RepeatRules) -> DataFrame:
    """Covered spans as they are, and the bytes of each open run for the task of its seed."""
    schema = "seed long, doc long, start long, stop long, context binary"

    def run(batches):
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("marks")))
            for part in tb.slices(batch, "text", _PART):
                data, at = tb.flat(part.column("text"))
                found = runs_of(data, at, rules)
                open_runs, covered = _marked(part.column("marks"), found)
                ids = part.column("doc_id").to_numpy()
                low, high = found.low[open_runs], found.high[open_runs] + rules.length
                raw = data.tobytes()
                contexts = [raw[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                begin = at[found.text[open_runs]]
                start, stop, text = _merged(
                    found.low[covered], found.high[covered] + rules.length, found.text[covered]
                )
                spread = tb.mix(ids[text].view(np.uint64) ^ tb.mix(start.astype(np.uint64)))
                none = np.zeros(len(start), dtype=bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(np.r_[found.seed[open_runs], spread]),
                        pa.array(np.r_[ids[found.text[open_runs]], ids[text]]),
                        pa.array(np.r_[low - begin, start - at[text]]),
                        pa.array(np.r_[high - begin, stop - at[text]]),
                        pa.array(contexts + [None] * len(none), pa.binary()),
                    ],
                    names=["seed", "doc", "start", "stop", "context"],
                )

    return texts.mapInArrow(released(run), schema)


def _marked(marks: pa.Array, found: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Which runs are open and which covered, by the marks of their texts."""
    entries = marks.flatten()
    owner = np.repeat(np.arange(len(marks)), pc.list_value_length(marks).to_numpy())
    key = tb.mix(entries.field("whole").to_numpy().view(np.uint64)) + owner.astype(np.uint64)
    kind = entries.field("open").to_numpy(zero_copy_only=False)
    mine = tb.mix(found.whole) + found.text.astype(np.uint64)
    return np.isin(mine, key[kind]), np.isin(mine, key[~kind])


def _merged(start, stop, text):
    """Union of the spans of each text; spans come in order of their starts within a text."""
    if not len(start):
        return start, stop, text
    # Ends never fall within a text, since spans of a text start and end in the same order.
    new = np.r_[True, (start[1:] > stop[:-1]) | (text[1:] != text[:-1])]
    first = np.flatnonzero(new)
    return start[first], stop[np.r_[first[1:] - 1, len(stop) - 1]], text[first]


def _windows(rows: DataFrame, rules: RepeatRules) -> DataFrame:
    """A row for each start of an open run; covered spans go through as they are."""
    schema = "seed long, part long, doc long, start long, stop long"

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                is_open = part.column("context").is_valid().to_numpy(zero_copy_only=False)
                seed, doc, start, stop = (
                    part.column(c).to_numpy() for c in ("seed", "doc", "start", "stop")
                )
                data, at = _bytes(part.column("context"))
                n = np.where(is_open, np.diff(at) - rules.length + 1, 0)
                row = np.repeat(np.arange(len(n)), n)
                inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                sums, down = tb.prefix_hash(data)
                here = at[row] + inner
                part_hash = tb.range_hash(sums, down, here, here + rules.length)
                done = ~is_open
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.r_[seed[row], seed[done]]),
                        pa.array(np.r_[part_hash.view(np.int64), np.zeros(done.sum(), np.int64)]),
                        pa.array(np.r_[doc[row], doc[done]]),
                        pa.array(np.r_[start[row] + inner, start[done]]),
                        pa.array(np.r_[start[row] + inner + rules.length, stop[done]]),
                    ],
                    names=["seed", "part", "doc", "start", "stop"],
                )

    return rows.mapInArrow(released(run), schema)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(buffers[2] or b"", np.uint8)[at[0] : at[-1]], at - at[0]


def _repeated_spans(rows: DataFrame, rules: RepeatRules) -> DataFrame:
    """``doc, start, stop`` of covered spans and of starts that a smaller document has too."""

    def run(batches):
        seed_before = part_before = holder = None
        for batch in batches:
            if not batch.num_rows:
                continue
            seed, part, doc, start, stop = (
                batch.column(c).to_numpy() for c in ("seed", "part", "doc", "start", "stop")
            )
            new = np.r_[
                seed_before is None or seed[0] != seed_before or part[0] != part_before,
                (seed[1:] != seed[:-1]) | (part[1:] != part[:-1]),
            ]
            first = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            smallest = np.where(first >= 0, doc[first], holder if holder is not None else 0)
            seed_before, part_before, holder = seed[-1], part[-1], smallest[-1]
            keep = (doc > smallest) | (part == 0)
            doc, start, stop = doc[keep], start[keep], stop[keep]
            order = np.lexsort((start, doc))
            doc, start, stop = doc[order], start[order], stop[order]
            reach = stop
            if len(doc):
                # Neighbouring starts make one span.
                new = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > stop[:-1])]
                head = np.flatnonzero(new)
                reach = np.maximum.reduceat(stop, head)
                doc, start = doc[head], start[head]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(start), pa.array(reach)], names=["doc", "start", "stop"]
            )

    return rows.mapInArrow(released(run), "doc long, start long, stop long")


def repeated_spans(docs: DataFrame, rules: RepeatRules = RepeatRules()) -> tuple[DataFrame, DataFrame]:
    """The texts by doc_id, and ``doc, spans`` of what earlier documents hold too."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    sorted_seeds = (
        _seed_rows(texts, rules)
        .repartition(n, "seed")
        .sortWithinPartitions("seed", "whole", "doc")
    )
    marks = materialize(_marks(sorted_seeds), "marks")
    by_doc = marks.groupBy(F.col("doc").alias("marked")).agg(
        F.collect_list(F.struct("whole", "open")).alias("marks")
    )
    dealt = texts.repartition(n, "doc_id")
    marked = dealt.join(by_doc, F.col("doc_id") == F.col("marked"), "left").select(
        "doc_id", "text", "marks"
    )
    windows = _windows(_contexts(marked, rules).repartition(n, "seed"), rules)
    spans = _repeated_spans(windows.sortWithinPartitions("seed", "part", "doc"), rules)
    by_span = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return dealt, by_span


def _cut(text: bytes, spans) -> tuple[list[tuple[int, int]], list[bytes]]:
    """The union of the spans, and the pieces of the text between them."""
    union: list[list[int]] = []
    for start, stop in sorted(spans):
        if union and start <= union[-1][1]:
            union[-1][1] = max(union[-1][1], stop)
        else:
            union.append([start, stop])
    pieces, at = [], 0
    for start, stop in union:
        pieces.append(text[at:start])
        at = stop
    pieces.append(text[at:])
    return [tuple(x) for x in union], pieces


def repeats(docs: DataFrame, rules: RepeatRules = RepeatRules()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of each row of ``docs``."""
    texts, spans = repeated_spans(docs, rules)
    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start:long,stop:long>>"
    )

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text, found in zip(
                batch.column("doc_id").to_pylist(),
                batch.column("text").to_pylist(),
                batch.column("spans").to_pylist(),
                strict=True,
            ):
                raw = (text or "").encode()
                union, pieces = _cut(raw, [(s["start"], s["stop"]) for s in found or ()])
                digest = hashlib.sha256()
                for piece in pieces:
                    digest.update(piece)
                rows.append(
                    {
                        "doc_id": doc,
                        "n_bytes": len(raw),
                        "n_removed": sum(b - a for a, b in union),
                        "n_spans": len(union),
                        "kept_sha256": digest.hexdigest(),
                        "spans": [{"start": a, "stop": b} for a, b in union],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_REPEATS)

    joined = texts.join(spans, F.col("doc_id") == F.col("doc"), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(released(run), schema)


def without_repeats(docs: DataFrame, rules: RepeatRules = RepeatRules()) -> DataFrame:
    """``docs`` without repeated strings, in its columns; ``n_chars`` follows a changed text.

    A character that loses some of its bytes goes entirely.
    """
    _, spans = repeated_spans(docs, rules)
    names, plain = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    key, text = plain[names.index("doc_id")], plain[names.index("text")]
    size = plain[names.index("n_chars")] if "n_chars" in names else None
    renamed = docs.toDF(*plain)
    dealt = renamed.repartition(
        int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col(key).cast("long")
    )
    joined = dealt.join(spans, F.col(key).cast("long") == F.col("doc"), "left").drop("doc")

    def run(batches):
        for batch in batches:
            found = batch.column("spans").to_pylist()
            texts = batch.column(text).to_pylist()
            sizes = batch.column(size).to_pylist() if size else None
            for i, own in enumerate(found):
                if own:
                    _, pieces = _cut(texts[i].encode(), [(s["start"], s["stop"]) for s in own])
                    texts[i] = b"".join(pieces).decode(errors="ignore")
                    if size:
                        sizes[i] = len(texts[i])
            out = []
            for name in plain:
                column = batch.column(name)
                if name == text:
                    column = pa.array(texts, column.type)
                elif name == size:
                    column = pa.array(sizes, column.type)
                out.append(column)
            yield pa.RecordBatch.from_arrays(out, names=plain)

    return joined.mapInArrow(released(run), renamed.schema).toDF(*names)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_REPEATS = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
        ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", _SPANS),
    ]
)
