"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words at the fixed positions of a mask; the words at its other positions
may differ. Seeds of the benchmark are looked up in every text, word by word. Around each hit the
text and the item are aligned without gaps over the whole item, and the stretch of the highest score
(a word that agrees gains one, a substitution costs ``cost``) is the overlap. It counts if it has
``least`` agreeing words, or a share ``share`` of a shorter item.

The benchmark comes to the tasks in blocks of a bounded number of words; each block is one pass over
the texts, so a benchmark of any size is compared with all of them.

Words are runs of letters, digits and bytes beyond ASCII, with A-Z as a-z, so punctuation and line
ends don't matter. Items shorter than a mask are looked up whole.

Defined cases: null or empty texts and items match nothing; rows without an id are left out of the
pairs, and ``clean_documents`` keeps them; repeated rows give one pair; an empty benchmark gives no
pairs; other columns pass through ``clean_documents`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import textbytes as tb
from riskspark.llm.graph import without_ids
from riskspark.llm.runtime import released
from riskspark.session import materialize

#: Positions that count (1) and that may differ (0).
MASKS = ("11101101101", "1101110111", "11011010111", "1110110111")
_FILTER_BITS = 22


@dataclass(frozen=True)
class LeakRules:
    """Masks, the score of a stretch, and what makes an overlap."""

    masks: tuple = MASKS
    least: int = 13
    share: float = 0.8
    cost: int = 2
    block_words: int = 500_000


def name_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the first word of each text."""
    data, at = tb.flat(column)
    starts, stops, first = tb.word_spans(data, at, tb.NAME_BYTES)
    sums, down = tb.prefix_hash(tb.lowered(data))
    return tb.range_hash(sums, down, starts, stops), first


def masked_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the masked window from each word on, as far as ``words`` goes."""
    n = max(0, len(words) - len(mask) + 1)
    out = np.full(n, np.uint64(int(mask, 2) * 2 + 1))
    for i, keep in enumerate(mask):
        if keep == "1":
            out += words[i : i + n] * tb.STEPS[i]
    return tb.mix(out)


class SeedTable:
    """Seeds of a block of items: sorted hashes, and the item and place of each."""

    def __init__(self, items: list[tuple[int, np.ndarray]], rules: LeakRules) -> None:
        self.rules = rules
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        longest = max(map(len, rules.masks))
        # An item that no mask fits in is looked up whole.
        whole = {"1" * len(w) for w in self.words if 0 < len(w) < longest}
        self.masks = [*rules.masks, *sorted(whole)]
        hashes, numbers, places = [], [], []
        for mask in self.masks:
            for number, words in enumerate(self.words):
                if mask in whole and len(words) != len(mask):
                    continue
                found = masked_hashes(words, mask)
                hashes.append(found)
                numbers.append(np.full(len(found), number))
                places.append(np.arange(len(found)))
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes = self.hashes[order]
        self.numbers = np.concatenate(numbers)[order] if hashes else order
        self.places = np.concatenate(places)[order] if hashes else order
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self.hashes >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Word, item number and place in the item of all equal seeds."""
        for mask in self.masks:
            found = masked_hashes(words, mask)
            at = np.flatnonzero(self.filter[found >> np.uint64(64 - _FILTER_BITS)])
            low = np.searchsorted(self.hashes, found[at], side="left")
            high = np.searchsorted(self.hashes, found[at], side="right")
            n = high - low
            seed = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(at, n), self.numbers[seed], self.places[seed]


def best_stretch(equal: np.ndarray, cost: int) -> tuple[int, int]:
    """Start and stop of the stretch with the highest score; the first one of equals."""
    scores = np.where(equal, 1, -cost)
    sums = np.concatenate([[0], np.cumsum(scores)])
    lowest = np.minimum.accumulate(sums)
    stop = int(np.argmax(sums - lowest))
    start = int(np.flatnonzero(sums[: stop + 1] == lowest[stop])[-1])
    return start, stop


def _overlaps(words, first, table: SeedTable) -> Iterator[tuple]:
    """Text, item number, agreeing words, aligned words, start in text and in item."""
    rules = table.rules
    diagonals = []
    for at, number, place in table.hits(words):
        text = np.searchsorted(first, at, side="right") - 1
        diagonals.append(np.stack([text, number, at - place], axis=1))
    if not diagonals:
        return
    for text, number, begin in np.unique(np.concatenate(diagonals), axis=0).tolist():
        item = table.words[number]
        low = max(begin, int(first[text]))
        high = min(begin + len(item), int(first[text + 1]))
        if high <= low:
            continue
        equal = words[low:high] == item[low - begin : high - begin]
        start, stop = best_stretch(equal, rules.cost)
        agree = int(equal[start:stop].sum())
        if agree >= min(rules.least, -(-int(rules.share * 100) * len(item) // 100)) and agree:
            yield (
                text, number, agree, stop - start,
                low + start - int(first[text]), low + start - begin,
            )


_SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "item_id", "n_equal", "n_aligned", "doc_word", "item_word")]
)


def _pass(docs: DataFrame, items: list, rules: LeakRules) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        table = SeedTable(shared.value, rules)
        for batch in batches:
            rows = []
            for part in tb.slices(batch, "text"):
                words, first = name_hashes(part.column("text"))
                ids = part.column("doc_id")
                for text, number, *rest in _overlaps(words, first, table):
                    rows.append((ids[text].as_py(), table.ids[number], *rest))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_SCHEMA
                )

    return docs.mapInArrow(released(run), ", ".join(f"{name} long" for name in _SCHEMA.names))


def _blocks(benchmark: DataFrame, rules: LeakRules) -> Iterator[list]:
    """Hashed items, read partition by partition, in blocks of a bounded number of words."""
    rows = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    block, size = [], 0
    for row in rows.toLocalIterator():
        words, _ = name_hashes(pa.array([row["text"]], pa.string()))
        if block and size + len(words) > rules.block_words:
            yield block
            block, size = [], 0
        if len(words):
            block.append((row["item_id"], words))
            size += len(words)
    if block:
        yield block


def overlaps(docs: DataFrame, benchmark: DataFrame, rules: LeakRules = LeakRules()) -> DataFrame:
    """``doc_id, item_id`` with the longest overlap of each pair that overlaps."""
    texts = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    found = [
        materialize(_pass(texts, block, rules), "overlaps") for block in _blocks(benchmark, rules)
    ]
    if not found:
        found = [docs.sparkSession.createDataFrame([], ", ".join(f"{n} long" for n in _SCHEMA.names))]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    rest = ("n_equal", "n_aligned", "doc_word", "item_word")
    best = F.max(F.struct("n_equal", -F.col("n_aligned"), -F.col("doc_word"), -F.col("item_word")))
    return (
        every.groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.n_equal").alias(rest[0]),
            *((-F.col(f"best.col{i}")).alias(n) for i, n in enumerate(rest[1:], start=2)),
        )
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, rules: LeakRules = LeakRules()
) -> DataFrame:
    """The documents that overlap with no item, in the columns of ``docs``."""
    leaked = materialize(
        overlaps(docs, benchmark, rules).select("doc_id").distinct(),
        "leaked",
    )
    return without_ids(docs, leaked, "doc_id")
