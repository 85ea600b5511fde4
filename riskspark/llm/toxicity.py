"""Toxicity classifier with a counterfactual penalty.

Logistic regression on the presence of hashed words and word beginnings. It learns from labelled
texts that are not held out, at most ``max_rows`` of each label (those of the smallest hash of
doc_id), so what reaches the driver is bounded; all documents are scored inside tasks with the
weights, a table of fixed size. Each labelled text that names a group of people is paired with a
copy that names another group of the same kind, and training adds ``penalty`` times the squared
change of the score between the two, so that naming a group says little by itself.

Defined cases: a null text is empty and gets the score of no words; labels of one document that
differ count as toxic if any does; null labels are no labels; without labels of both kinds every
score is the share of toxic ones (one half without any); repeated rows are scored alike; an empty
table gives an empty result; columns other than doc_id and text are no inputs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm import textbytes as tb
from riskspark.llm.graph import with_ids

# Names of groups of people, by kind.
IDENTITY_GROUPS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist"),
    ("muslims", "christians", "jews", "hindus", "buddhists"),
    ("women", "men"),
    ("woman", "man"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "refugees", "natives"),
    ("african", "european", "american", "arab"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
)


@dataclass(frozen=True)
class ToxicityRules:
    """Parameters of features and training."""

    bits: int = 20
    prefixes: tuple = (4, 5, 6)
    max_rows: int = 3000
    max_features: int = 3000
    min_texts: int = 3
    ridge: float = 1e-4
    penalty: float = 1.0
    steps: int = 150
    groups: tuple = IDENTITY_GROUPS


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def features(column: pa.Array, rules: ToxicityRules):
    """Sorted distinct feature numbers of each text."""
    data, at = tb.flat(column)
    starts, stops, first = tb.word_spans(data, at, tb.NAME_BYTES)
    sums, down = tb.prefix_hash(tb.lowered(data))
    shift = np.uint64(64 - rules.bits)
    kinds = [tb.range_hash(sums, down, starts, stops) >> shift]
    for length in rules.prefixes:
        cut = np.minimum(starts + length, stops)
        salted = tb.range_hash(sums, down, starts, cut) + np.uint64(length)
        # A word shorter than the beginning counts once, as itself.
        kinds.append(np.where(stops - starts > length, tb.mix(salted) >> shift, kinds[0]))
    numbers = np.stack(kinds, axis=1).astype(np.int32)
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield np.unique(numbers[begin:end])


def swap_terms(text: str, groups: tuple) -> str:
    """The text with each group's name replaced by the next one of its kind."""
    following = {
        name: kind[(i + 1) % len(kind)] for kind in groups for i, name in enumerate(kind)
    }
    pattern = r"(?<![^\W_])(" + "|".join(sorted(following, key=len, reverse=True)) + r")(?![^\W_])"
    return re.sub(pattern, lambda m: following[m[0].lower()], text, flags=re.I | re.A)


def _matrix(texts: list[str], rules: ToxicityRules) -> tuple[np.ndarray, np.ndarray]:
    """Features of all texts in one array, and the row of each."""
    rows = []
    for i in range(0, len(texts), 200):
        rows += list(features(pa.array(texts[i : i + 200], pa.string()), rules))
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    return (
        np.concatenate(rows) if rows else np.zeros(0, np.int32),
        np.repeat(np.arange(len(rows)), sizes),
    )


def train(texts: list[str], toxic: list[int], rules: ToxicityRules) -> Model:
    """Full-batch gradient steps with adaptive rates; the same input gives the same weights."""
    width = 1 << rules.bits
    y = np.array(toxic, dtype=np.float64)
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0):
        inside = min(max(share, 1e-3), 1 - 1e-3)
        return Model(np.zeros(width, np.float32), float(np.log(inside / (1 - inside))))
    number, row = _matrix(texts, rules)
    in_toxic = np.bincount(number, weights=y[row], minlength=width)
    in_all = np.bincount(number, minlength=width)
    rate = (in_toxic + 0.5) / (y.sum() + 1)
    other = (in_all - in_toxic + 0.5) / ((1 - y).sum() + 1)
    telling = np.abs(np.log(rate / other)) * np.sqrt(in_all) * (in_all >= rules.min_texts)
    chosen = np.flatnonzero(telling)
    if len(chosen) > rules.max_features:
        chosen = np.sort(chosen[np.argsort(-telling[chosen], kind="stable")[: rules.max_features]])
    place = np.full(width, -1)
    place[chosen] = np.arange(len(chosen))

    swapped = [swap_terms(t, rules.groups) for t in texts]
    paired = [i for i, (a, b) in enumerate(zip(texts, swapped, strict=True)) if a != b]
    new_number, new_row = _matrix([swapped[i] for i in paired], rules)

    def kept(number, row):
        seen = place[number] >= 0
        return place[number[seen]], row[seen]

    x, at = kept(number, row)
    old = np.isin(at, paired)
    position = np.full(len(texts), -1)
    position[paired] = np.arange(len(paired))
    # The change between a text and its counterpart, feature by feature.
    new_x, new_at = kept(new_number, new_row)
    d_x = np.r_[new_x, x[old]]
    d_at = np.r_[new_at, position[at[old]]]
    d_sign = np.r_[np.ones(len(new_x)), -np.ones(int(old.sum()))]

    k, n, pairs = len(chosen), len(y), max(1, len(paired))
    w, b = np.zeros(k), 0.0
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    balance = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / n
    for step in range(1, rules.steps + 1):
        z = np.bincount(at, weights=w[x], minlength=n) + b
        residual = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * balance
        change = np.bincount(d_at, weights=d_sign * w[d_x], minlength=len(paired)) if len(paired) else np.zeros(0)
        slope = np.bincount(x, weights=residual[at], minlength=k) + rules.ridge * w
        if len(paired):
            slope += 2 * rules.penalty / pairs * np.bincount(
                d_x, weights=d_sign * change[d_at], minlength=k
            )
        g = np.r_[slope, residual.sum()]
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    weights = np.zeros(width, np.float32)
    weights[chosen] = w
    return Model(weights, float(b))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, rules: ToxicityRules) -> DataFrame:
    """``text, toxic`` of at most ``max_rows`` labelled documents of each label."""
    labelled = (
        labels.where("doc_id is not null and toxic is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    )
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    present = labelled.join(own.select("doc_id").distinct(), "doc_id", "left_semi")
    parts = [
        present.where(F.col("toxic") == kind)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rules.max_rows)
        for kind in (0, 1)
    ]
    chosen = parts[0].unionByName(parts[1])
    texts = with_ids(own, chosen.select("doc_id"), "doc_id")
    return (
        chosen.join(texts, "doc_id")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"), F.coalesce(F.min("text"), F.lit("")).alias("text"))
        .orderBy("doc_id")
        .select("text", "toxic")
    )


def score(docs: DataFrame, model: Model, rules: ToxicityRules) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches):
        weights, bias = shared.value
        for batch in batches:
            for part in tb.slices(batch, "text"):
                z = np.array(
                    [weights[x].sum(dtype=np.float64) for x in features(part.column("text"), rules)]
                )
                p = 1 / (1 + np.exp(-np.clip(z + bias, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, rules: ToxicityRules = ToxicityRules()) -> DataFrame:
    rows = training_rows(docs, labels, rules).collect()
    model = train([r["text"] for r in rows], [r["toxic"] for r in rows], rules)
    return score(docs, model, rules)
