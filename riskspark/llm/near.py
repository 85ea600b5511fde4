"""Near-duplicates by MinHash bands and sequential Bayesian verification.

Documents with equal shingle sets are one class from the start. Each class has a signature of
``bands * rows`` minima of eight bits; classes that agree in all rows of a band share a bucket.
Pairs of a bucket are not listed. Each member is first compared with one leader of the bucket (in as
many rounds as asked for, with other leaders); links make components, and a bucket whose members are
all in one component is done. What is left, pairs of different components within a bucket, is compared block
by block, so that no task holds more than two blocks and no pair of them is missed.

Blocks hold the texts too, so survivors are verified there, and links within what a block has
already joined are left out: rows grow with the members of a bucket, not with its pairs.

Comparing a pair is sequential: the signatures are read batch by batch, and the pair is dropped as
soon as the posterior probability that its similarity reaches the threshold (uniform prior,
binomial matches) falls below ``miss``. Survivors are verified on their full shingle sets.

Defined cases: a null or empty text, or one without words, has no shingles and no links; a text of
fewer words than a shingle is one shingle; repeated rows get one result for each row; a row without a
doc_id takes part in no link and is kept; rows that share a doc_id share their links; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import textbytes as tb
from riskspark.llm.graph import components, with_ids, without_ids
from riskspark.llm.runtime import released
from riskspark.session import materialize

_MULTIPLY = (tb.mix(np.arange(1, 4097, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | 1
_OTHER = np.uint64(0xA5A5A5A5A5A5A5A5)
_ADD = (tb.mix(np.arange(5001, 9097, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


@dataclass(frozen=True)
class NearRules:
    """Shingle words, similarity in per cent, bands and rows, and the miss probability."""

    shingle: int = 5
    percent: int = 80
    bands: int = 48
    rows: int = 6
    miss: float = 1e-6
    batch: int = 48
    rounds: int = 1
    block: int = 512

    @property
    def size(self) -> int:
        return self.bands * self.rows


def _at_least(matches: int, n: int, p: float) -> float:
    """Posterior probability of a rate of at least ``p`` after ``matches`` of ``n``.

    The tail of Beta(matches + 1, n - matches + 1) is a sum of binomial terms.
    """
    return sum(
        exp(
            lgamma(n + 2) - lgamma(k + 1) - lgamma(n + 2 - k)
            + k * log(p) + (n + 1 - k) * log(1 - p)
        )
        for k in range(matches + 1)
    )


@lru_cache
def least_matches(rules: NearRules) -> tuple[tuple[int, int], ...]:
    """After so many rows, a pair with fewer matches than this is dropped."""
    p = rules.percent / 100
    p += (1 - p) / 256  # eight bits agree by chance
    ends = [*range(rules.batch, rules.size, rules.batch), rules.size]
    return tuple(
        (n, next(m for m in range(n + 1) if _at_least(m, n, p) >= rules.miss)) for n in ends
    )


def signature(shingles: np.ndarray, size: int) -> bytes:
    """Minima of ``size`` hash functions over the set, eight bits of each."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(x), 4096):
        values = _MULTIPLY[:size, None] * x[None, start : start + 4096]
        values += _ADD[:size, None]
        np.minimum(least, values.min(axis=1), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, rules: NearRules) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, sig`` of each row; no signature without shingles."""

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                sizes, one, two, sigs = [], [], [], []
                for shingles in tb.shingle_sets(part.column("text"), rules.shingle):
                    sizes.append(len(shingles))
                    one.append(int(shingles.sum(dtype=np.uint64)))
                    two.append(int(tb.mix(shingles ^ _OTHER).sum(dtype=np.uint64)))
                    sigs.append(signature(shingles, rules.size) if len(shingles) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(np.array(one, np.uint64).view(np.int64)),
                        pa.array(np.array(two, np.uint64).view(np.int64)),
                        pa.array(sigs, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "sig"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        released(run), "doc_id long, n_shingles long, set_a long, set_b long, sig binary"
    )


def _sig_matrix(column: pa.Array, size: int) -> np.ndarray:
    column = column.cast(pa.binary())
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    data = np.frombuffer(column.buffers()[2], np.uint8)[at : at + len(column) * size]
    return data.reshape(len(column), size)


def band_rows(classes: DataFrame, rules: NearRules) -> DataFrame:
    """``key, doc`` for each band of each class: the band's number and its rows' bits."""
    if rules.rows > 6 or rules.bands > 1 << 15:
        raise ValueError("a band's key has 16 bits for its number and 48 for its rows")

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                sigs = _sig_matrix(part.column("sig"), rules.size)
                keys = np.zeros((part.num_rows, rules.bands), dtype=np.int64)
                for r in range(rules.rows):
                    keys = keys * 256 + sigs[:, r :: rules.rows]
                keys += np.arange(rules.bands, dtype=np.int64) << 48
                ids = part.column("doc").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(ids, rules.bands))],
                    names=["key", "doc"],
                )

    return classes.select("doc", "sig").mapInArrow(released(run), "key long, doc long")


def _survivors(a: np.ndarray, b: np.ndarray, rules: NearRules) -> np.ndarray:
    """Rows of two signature matrices that no batch drops."""
    left, matches, done = np.arange(len(a)), np.zeros(len(a), dtype=np.int64), 0
    for n, least in least_matches(rules):
        matches = matches + (a[left, done:n] == b[left, done:n]).sum(axis=1)
        good = matches >= least
        left, matches, done = left[good], matches[good], n
        if not len(left):
            break
    return left


def prune(pairs: DataFrame, classes: DataFrame, rules: NearRules) -> DataFrame:
    """The pairs ``a, b`` that the sequential comparison of signatures leaves."""
    sigs = classes.select("doc", "sig")

    def run(batches):
        for batch in batches:
            one, two = (_sig_matrix(batch.column(c), rules.size) for c in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).take(pa.array(_survivors(one, two, rules)))

    return (
        pairs.select("a", "b")
        .join(sigs.select(F.col("doc").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(sigs.select(F.col("doc").alias("b"), F.col("sig").alias("sig_b")), "b")
        .mapInArrow(released(run), "a long, b long")
    )


def verify(pairs: DataFrame, texts: DataFrame, rules: NearRules) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                one, two = (
                    _sets(part.column(c), rules.shingle) for c in ("text_a", "text_b")
                )
                linked = []
                for row, (x, y) in enumerate(zip(one, two, strict=True)):
                    if _similar(x, y, rules):
                        linked.append(row)
                yield part.select(["a", "b"]).take(pa.array(linked, pa.int64()))

    return (
        pairs.select("a", "b")
        .join(texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
        .mapInArrow(released(run), "a long, b long")
    )


def _similar(x: np.ndarray, y: np.ndarray, rules: NearRules) -> bool:
    """Whether two full sets reach the threshold."""
    if 100 * min(len(x), len(y)) < rules.percent * max(len(x), len(y)):
        return False
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    common = int((x[at] == y).sum())
    return 100 * common >= rules.percent * (len(x) + len(y) - common)


def _sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Shingle sets of a column; a text that comes again is shingled once."""
    coded = column.dictionary_encode()
    sets = list(tb.shingle_sets(coded.dictionary, n))
    return [sets[i] for i in coded.indices.to_numpy()]


def _block_pairs(members: DataFrame, sizes: DataFrame, rules: NearRules) -> DataFrame:
    """Members of a bucket once for each pair of blocks they are needed in."""
    n = F.ceil(F.col("n") / rules.block).cast("int")
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        members.join(sizes.select("key", n.alias("blocks")), "key")
        .withColumn("own", own)
        .withColumn("other", other)
        .select(
            "key", "doc", "component", "own",
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        )
    )


class _Forest:
    """Which rows of a block are joined so far, beginning with their components."""

    def __init__(self, labels: np.ndarray) -> None:
        self.label = labels.copy()

    def join(self, a: int, b: int) -> None:
        self.label[self.label == self.label[b]] = self.label[a]


def _compare_blocks(table: pa.RecordBatch, rules: NearRules) -> tuple[list, list]:
    """Links between different components of a block, or of two, enough to join them.

    A pair is looked at in its first common band alone.
    """
    ids, own = (table.column(c).to_numpy() for c in ("doc", "own"))
    key, i, j = (table.column(c)[0].as_py() for c in ("key", "i", "j"))
    forest = _Forest(table.column("component").to_numpy())
    sigs = _sig_matrix(table.column("sig"), rules.size)
    cut = sigs.reshape(len(ids), rules.bands, rules.rows)
    earlier = slice(0, key >> 48)
    rows = np.flatnonzero(own == i)
    against = rows if i == j else np.flatnonzero(own == j)
    sets: dict[int, np.ndarray] = {}

    def shingles(row: int) -> np.ndarray:
        if row not in sets:
            sets[row] = next(tb.shingle_sets(table.column("text").slice(row, 1), rules.shingle))
        return sets[row]

    found_a, found_b = [], []
    for row in rows.tolist():
        other = against[against > row] if i == j else against
        other = other[forest.label[other] != forest.label[row]]
        if not len(other):
            continue
        seen = (cut[other, earlier] == cut[row, earlier]).all(axis=2).any(axis=1)
        other = other[~seen]
        mine = np.broadcast_to(sigs[row], (len(other), rules.size))
        for k in other[_survivors(sigs[other], mine, rules)].tolist():
            if forest.label[k] != forest.label[row] and _similar(shingles(row), shingles(k), rules):
                forest.join(row, k)
                found_a.append(ids[row])
                found_b.append(ids[k])
    return found_a, found_b


def cross_links(
    members: DataFrame, sizes: DataFrame, classes: DataFrame, rules: NearRules
) -> DataFrame:
    """Links ``a, b`` between different components that share a bucket."""
    signed = _block_pairs(members, sizes, rules).join(classes, "doc")
    n = int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = ["key", "i", "j"]
    ordered = signed.repartition(n, *group).sortWithinPartitions(*group)

    def compare(table: pa.RecordBatch):
        a, b = _compare_blocks(table, rules)
        if a:
            a, b = np.array(a), np.array(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
            )

    def run(batches):
        """Groups follow one another; only the last one of a batch can go on in the next."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = np.stack([batch.column(c).to_numpy() for c in group])
            cuts = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
            edges = [0, *cuts.tolist(), batch.num_rows]
            if held and [held[0].column(c)[0].as_py() for c in group] != columns[:, 0].tolist():
                yield from compare(_joined(held))
                held = []
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                held.append(batch.slice(start, stop - start))
                if stop < batch.num_rows:
                    yield from compare(_joined(held))
                    held = []
        if held:
            yield from compare(_joined(held))

    return ordered.mapInArrow(released(run), "a long, b long")


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def near_duplicates(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs``."""
    sigs = materialize(signatures(docs, rules), "signatures")
    whole = sigs.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = materialize(
        whole.groupBy("set_a", "set_b").agg(
            F.min("doc_id").alias("doc"), F.any_value("sig").alias("sig")
        ),
        "classes",
    )
    links = _links(docs.where("doc_id is not null"), classes, rules)
    merged = components(links)
    to = F.coalesce("component", "doc").alias("component_id")
    of_class = classes.join(merged, F.col("doc") == F.col("node"), "left").select(
        "set_a", "set_b", to
    )
    return sigs.select("doc_id", "n_shingles", "set_a", "set_b").join(
        of_class, ["set_a", "set_b"], "left"
    ).select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def clean_documents(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """One document of each group, the one of the smallest doc_id, in the columns of ``docs``.

    Of rows that share a doc_id one stays; rows without one all stay.
    """
    judged = materialize(near_duplicates(docs, rules), "judged")
    gone = judged.where("not kept and doc_id is not null").select("doc_id").distinct()
    left = without_ids(docs, materialize(gone, "gone"), "doc_id")
    again = materialize(
        judged.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again"
    )
    if again.isEmpty():
        return left
    single = with_ids(left, again, "doc_id").dropDuplicates(["doc_id"])
    return without_ids(left, again, "doc_id").unionByName(single)


def _links(docs: DataFrame, classes: DataFrame, rules: NearRules) -> DataFrame:
    """Links between classes, enough of them for the components."""
    rows = band_rows(classes, rules)
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    members = materialize(rows.join(shared.select("key"), "key"), "members")
    taking_part = materialize(members.select(F.col("doc").alias("doc_id")).distinct(), "ids")
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    texts = materialize(
        with_ids(own, taking_part, "doc_id")
        .groupBy(F.col("doc_id").alias("doc"))
        .agg(F.min("text").alias("text")),
        "texts",
    )
    signed = materialize(classes.select("doc", "sig").join(texts, "doc"), "signed")

    links = members.sparkSession.createDataFrame([], "a long, b long")
    tried = links
    grouped = members.withColumn("component", F.col("doc"))
    for turn in range(rules.rounds):
        first = F.col("doc") if turn == 0 else F.xxhash64("doc", F.lit(turn))
        leaders = (
            grouped.groupBy("key")
            .agg(
                F.min(F.struct(first.alias("o"), "doc", "component")).alias("first"),
                F.min("component").alias("low"),
                F.max("component").alias("high"),
            )
            .where(F.col("low") < F.col("high"))
            .select("key", F.col("first.doc").alias("leader"), F.col("first.component").alias("of"))
        )
        pairs = (
            grouped.join(leaders, "key")
            .where(F.col("component") != F.col("of"))
            .select(F.least("doc", "leader").alias("a"), F.greatest("doc", "leader").alias("b"))
            .distinct()
        )
        pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        new = verify(prune(pairs, signed, rules), texts, rules)
        links = materialize(links.unionByName(new), "links")
        tried = tried.unionByName(pairs)
        merged = materialize(components(links), "components")
        grouped = members.join(merged, F.col("doc") == F.col("node"), "left").select(
            "key", "doc", F.coalesce("component", "doc").alias("component")
        )
    grouped = materialize(grouped, "grouped")
    still = (
        grouped.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .where(F.col("low") < F.col("high"))
    )
    return materialize(links.unionByName(cross_links(grouped, still, signed, rules)), "links")
