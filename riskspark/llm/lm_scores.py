"""Cross-entropy difference of two matched n-gram models.

The target model learns from documents labelled good and not toxic, the background model from the
others. Words and bigrams of all documents are counted, and the background's counts are scaled down
to the number of the target's words (matched sizes). Both are bigram
models with absolute discounting over one vocabulary: the ``vocabulary`` most frequent words of what
the two learn from, equally frequent ones by their hash; every other word is <unk>. Bigrams seen fewer than ``least`` times in both
together back off. A document's score is its mean loss per word under the target model minus that
under the background model; the lower, the more like the target.

The difference of the two losses is a sum of table values: one for the word, one for the word before
it, and a correction if the bigram is in the models. The first two tables have the size of the
vocabulary, and the most frequent bigrams, at most ``head``, a fixed size: they go to the tasks. All further
bigrams, which grow with the corpus, are joined: a filter of a fixed size spares most of those that
are in no model, so only documents' rarer modelled bigrams are shuffled.

Defined cases: a null or empty text has no words and score 0; unlabelled documents are no targets,
labels that differ count as bad if any does; without targets every score is 0; repeated rows are
scored alike and each counts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm import textbytes as tb
from riskspark.llm.graph import BROADCAST_IDS
from riskspark.session import materialize

_BLOOM_BITS = 26


@dataclass(frozen=True)
class LmRules:
    """Vocabulary, bigram cut-off, discount and bigrams sent to each task."""

    vocabulary: int = 200_000
    least: int = 3
    discount: float = 0.75
    head: int = 50_000


def _training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, hash, target`` of all documents."""
    good = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("good_id"))
        .agg(
            F.min(F.coalesce(F.col("quality"), F.lit(0))).alias("quality"),
            F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("toxic"),
        )
        .where("quality > 0 and toxic = 0")
        .select("good_id")
    )
    good = materialize(good, "targets")
    few = good.count() <= BROADCAST_IDS
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("hash"),
    )
    joined = own.join(F.broadcast(good) if few else good, F.col("doc_id") == F.col("good_id"), "left")
    return joined.withColumn("target", F.col("good_id").isNotNull()).drop("good_id")


def _counted(batches, keys_of):
    """Distinct keys of each part of the scan with their counts in target and background."""
    for batch in batches:
        target = batch.column("target").to_numpy(zero_copy_only=False)
        keys, sides = [], []
        for part in tb.slices(batch.append_column("row", pa.array(np.arange(batch.num_rows))), "text"):
            found, row = keys_of(part.column("text"))
            keys.append(found)
            sides.append(target[part.column("row").to_numpy()][row])
        if not keys:
            continue
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        side = np.concatenate(sides)
        in_target = np.bincount(place[side], minlength=len(every))
        in_back = np.bincount(place[~side], minlength=len(every))
        yield pa.RecordBatch.from_arrays(
            [pa.array(every.view(np.int64)), pa.array(in_target), pa.array(in_back)],
            names=["key", "t", "b"],
        )


def _summed(rows: DataFrame, run) -> DataFrame:
    return (
        rows.mapInArrow(run, "key long, t long, b long")
        .groupBy("key")
        .agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
    )


def _row_of(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def word_counts(rows: DataFrame) -> DataFrame:
    """``key, t, b``: counts of each word's hash."""

    def keys_of(column):
        words, first = tb.word_hashes(column)
        return words, _row_of(first)

    return _summed(rows, lambda batches: _counted(batches, keys_of))


def word_ids(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Place in the sorted vocabulary from 1 on; 0 for <unk>."""
    if not len(vocabulary):
        return np.zeros(len(words), dtype=np.int64)
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    return np.where(vocabulary[at] == words, at + 1, 0)


def bigrams(column: pa.Array, vocabulary: np.ndarray) -> tuple:
    """Ids of all words, keys of all bigrams, and the text of each."""
    words, first = tb.word_hashes(column)
    ids, row = word_ids(words, vocabulary), _row_of(first)
    inner = row[1:] == row[:-1]
    keys = (ids[:-1] << 32 | ids[1:])[inner]
    return ids, row, keys, row[1:][inner]


@dataclass
class Tables:
    """Log-ratio of the words (by id) and of the back-off of the words before."""

    vocabulary: np.ndarray
    word: np.ndarray
    before: np.ndarray


def least_of_top(rows: DataFrame, k: int) -> int:
    """The count ``n`` from which on at most ``k`` rows have it or more.

    Counts that sum up to M have at most sqrt(2 M) different values.
    """
    above, least = 0, None
    for r in sorted(rows.groupBy("n").count().collect(), key=lambda r: -r["n"]):
        above += r["count"]
        if above > k:
            break
        least = r["n"]
    return least if least is not None else (1 << 62)


def in_top(rows: DataFrame, k: int) -> Column:
    """Whether a row is one of the ``k`` of the highest ``n``, equal ones by the lowest ``key``.

    The place among equal ones comes from counts of hash prefixes, then from the keys of one prefix.
    """
    n, key = F.col("n"), F.col("key")
    least = least_of_top(rows, k)
    room = k - rows.where(n >= least).count()
    edge = rows.where(n < least).agg(F.max("n")).first()[0]
    if room <= 0 or edge is None:
        return n >= least
    tied, prefix = rows.where(n == edge), F.shiftright("key", 48)
    for r in sorted(tied.groupBy(prefix.alias("prefix")).count().collect()):
        if r["count"] >= room:
            break
        room -= r["count"]
    own = sorted(x["key"] for x in tied.where(prefix == r["prefix"]).select("key").collect())
    return (n >= least) | ((n == edge) & (key <= own[room - 1]))


def _columns(rows: DataFrame) -> dict[str, np.ndarray]:
    """A table of bounded size on the driver, by column."""
    table = rows.toArrow()
    return {name: table.column(name).to_numpy() for name in table.column_names}


def _ratio(target, back):
    return np.log(target) - np.log(back)


def models(training: DataFrame, rules: LmRules) -> tuple[Tables, DataFrame]:
    """The tables of the vocabulary's size, and ``key, value, n`` of the bigrams."""
    spark = training.sparkSession
    rows = training.select("text", "target")
    counted = materialize(word_counts(rows), "words")
    counted = counted.withColumn("n", F.col("t") + F.col("b"))
    chosen = _columns(counted.where(in_top(counted, rules.vocabulary)).select("key", "t", "b"))
    n_target, n_back = (x or 0 for x in counted.agg(F.sum("t"), F.sum("b")).first())
    scale = min(1.0, n_target / n_back) if n_back else 1.0
    weights = {"t": 1.0, "b": scale}
    hashes = chosen["key"].view(np.uint64)
    order = np.argsort(hashes)
    vocabulary = hashes[order]
    size = len(vocabulary) + 1
    unigram = []
    for side, total in (("t", n_target), ("b", n_back)):
        counts = np.zeros(size)
        counts[1:] = chosen[side][order]
        counts[0] = total - counts.sum()
        unigram.append((weights[side] * counts + 1) / (weights[side] * total + size))
    shared = spark.sparkContext.broadcast(vocabulary)

    def count_bigrams(batches):
        def keys_of(column):
            _, _, keys, row = bigrams(column, shared.value)
            return keys, row

        return _counted(batches, keys_of)

    pairs = materialize(_summed(rows, count_bigrams), "bigrams")
    before = F.shiftright("key", 32).cast("int").alias("before")
    kept = F.col("t") + F.col("b") >= rules.least

    def left(side: str):
        count = F.col(side) * F.lit(weights[side])
        return F.sum(
            F.when(kept, F.greatest(count - F.lit(rules.discount), F.lit(0.0))).otherwise(0.0)
        )

    contexts = _columns(
        pairs.groupBy(before).agg(
            F.sum("t").alias("t"), F.sum("b").alias("b"),
            left("t").alias("kept_t"), left("b").alias("kept_b"),
        )
    )
    shared.unpersist()
    totals, back_off = [], []
    for side in ("t", "b"):
        total, mass = np.zeros(size), np.zeros(size)
        total[contexts["before"]] = weights[side] * contexts[side]
        mass[contexts["before"]] = contexts[f"kept_{side}"]
        totals.append(total)
        back_off.append(np.where(total > 0, 1 - mass / np.maximum(total, 1), 1.0))
    back_off = [np.maximum(x, 1e-6) for x in back_off]
    tables = Tables(vocabulary, _ratio(*unigram), _ratio(*back_off))
    bundle = spark.sparkContext.broadcast((unigram, totals, back_off))

    def values(batches):
        unigram, totals, back_off = bundle.value
        for batch in batches:
            key, t, b = (batch.column(c).to_numpy() for c in ("key", "t", "b"))
            u, w = key >> 32, key & 0xFFFFFFFF
            both = []
            for side, counts in enumerate((t, scale * b)):
                seen = np.maximum(counts - rules.discount, 0) / np.maximum(totals[side][u], 1)
                lower = back_off[side][u] * unigram[side][w]
                both.append(np.log(seen + lower) - np.log(lower))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(both[0] - both[1]), pa.array(t + b)],
                names=["key", "value", "n"],
            )

    entries = materialize(
        pairs.where(kept).mapInArrow(values, "key long, value double, n long"), "entries"
    )
    bundle.unpersist()
    return tables, entries


def _places(keys: np.ndarray) -> list[np.ndarray]:
    """Two bits of the filter for each key."""
    mixed = tb.mix(keys.view(np.uint64))
    return [
        (mixed >> np.uint64(64 - _BLOOM_BITS)).astype(np.int64),
        (mixed & np.uint64((1 << _BLOOM_BITS) - 1)).astype(np.int64),
    ]


def _bloom(keys: DataFrame) -> np.ndarray:
    """A filter of fixed size over the keys, put together from its parts."""

    def run(batches):
        for batch in batches:
            places = np.unique(np.concatenate(_places(batch.column("key").to_numpy())))
            yield pa.RecordBatch.from_arrays([pa.array(places)], names=["place"])

    word = F.shiftright("place", 6)
    words = (
        keys.select("key")
        .mapInArrow(run, "place long")
        .groupBy(word.alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
    )
    out = np.zeros(1 << (_BLOOM_BITS - 6), dtype=np.uint64)
    found = _columns(words)
    out[found["word"]] = found["bits"].view(np.uint64)
    return out


def _perhaps(keys: np.ndarray, bloom: np.ndarray) -> np.ndarray:
    good = np.ones(len(keys), dtype=bool)
    for place in _places(keys):
        good &= (bloom[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0
    return good


def scores(docs: DataFrame, labels: DataFrame, rules: LmRules = LmRules()) -> DataFrame:
    """``doc_id, n_words, score`` of each row of ``docs``."""
    spark = docs.sparkSession
    training = _training(docs, labels)
    tables, entries = models(training, rules)
    in_head = F.col("n") >= least_of_top(entries, rules.head)
    head = _columns(entries.where(in_head).select("key", "value"))
    tail = entries.where(~in_head)
    bloom = _bloom(tail)
    order = np.argsort(head["key"])
    keys, corrections = head["key"][order], head["value"][order]
    bundle = spark.sparkContext.broadcast((tables, keys, corrections, bloom))
    out = pa.schema(
        [
            ("doc_id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()),
            ("gain", pa.float64()), ("rare", pa.list_(pa.int64())),
        ]
    )

    def run(batches):
        tables, keys, corrections, bloom = bundle.value
        for batch in batches:
            for part in tb.slices(batch, "text"):
                ids, row, pairs, pair_row = bigrams(part.column("text"), tables.vocabulary)
                n = part.num_rows
                gain = np.bincount(row, weights=tables.word[ids], minlength=n)
                gain += np.bincount(pair_row, weights=tables.before[pairs >> 32], minlength=n)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
                    known = keys[at] == pairs
                    gain += np.bincount(
                        pair_row[known], weights=corrections[at[known]], minlength=n
                    )
                else:
                    known = np.zeros(len(pairs), dtype=bool)
                maybe = np.flatnonzero(~known)
                maybe = maybe[_perhaps(pairs[maybe], bloom)]
                per_text = np.bincount(pair_row[maybe], minlength=n)
                offsets = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("hash"),
                        pa.array(np.bincount(row, minlength=n)), pa.array(gain),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(pairs[maybe])),
                    ],
                    schema=out,
                )

    scanned = training.select("doc_id", "hash", "text").mapInArrow(
        run, "doc_id long, row long, n_words long, gain double, rare array<long>"
    )
    known = materialize(scanned.withColumn("id", F.monotonically_increasing_id()), "gains")
    more = (
        known.select("id", F.explode("rare").alias("key"))
        .join(tail.select("key", "value"), "key")
        .groupBy("id")
        .agg(F.sum("value").alias("more"))
    )
    total = F.col("gain") + F.coalesce("more", F.lit(0.0))
    return known.join(more, "id", "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("n_words") > 0, -total / F.col("n_words")).otherwise(0.0).alias("score"),
    )
