"""Mixing sources to target weights by temperature.

A source of token share ``p`` gets the weight ``p ** x``, normalised over all sources. From ``x`` = 1
(as it is) to 0 (all alike), the entropy of the weights and the repetition of small sources grow.
The exponent is bisected, many cuts at a time: one aggregate over the sources tries 64 exponents, and
four passes narrow them to 63**-4. It is the largest one that reaches ``entropy`` (a share of the
highest), or the smallest one that keeps every source within ``most_repeats`` if that is larger.

Weights times the budget are token quotas. Each epoch of a source is a permutation: its documents
fall into blocks by hash, blocks and documents in a block are ordered by hashes with the epoch's
number. Full epochs are taken whole; the last one takes documents in that order as long as
their running sum is within what is left of the quota. Sums run over the blocks of a source, then
within the block that is cut, so no task holds a source's documents.

Defined cases: a null source is a source of its own; texts without words (or null) are never drawn;
repeated rows are drawn each for itself; a single source has weight 1; empty tables, or a
budget of 0, draw nothing; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.expressions import whole, words_of
from riskspark.session import materialize

_CUTS = 64


@dataclass(frozen=True)
class MixRules:
    """Target entropy (share of the highest), repetition limit, budget and block size."""

    entropy: float = 0.98
    most_repeats: float = 4.0
    budget_share: float = 1.0
    block_tokens: int = 200_000
    seed: int = 42


def document_tokens(docs: DataFrame) -> DataFrame:
    """``doc_id, source, n_tokens`` of each text with a word, and a hash of its row."""
    text = whole("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.size(words_of(text)).cast("long").alias("n_tokens"),
        F.xxhash64("doc_id", text).alias("row_hash"),
    ).where(F.col("n_tokens") > 0)


def source_totals(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("source").agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")
    )


def _measures(sources: DataFrame, exponents: list[float], rules: MixRules) -> list[tuple]:
    """Share of the highest entropy and the most repetitions, for each exponent.

    With s = p ** x, entropy is log(sum s) - sum(s log s) / sum s; a source is repeated
    s / sum s * budget / tokens times.
    """
    total, n = sources.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not n:
        return []
    grid = F.array(*(F.lit(x) for x in exponents))
    p = F.col("tokens") / F.lit(total)
    powers = sources.select("tokens", p.alias("p"), F.posexplode(grid).alias("i", "x"))
    summed = (
        powers.withColumn("s", F.pow("p", "x"))
        .groupBy("i")
        .agg(
            F.sum("s").alias("sum_s"),
            F.sum(F.col("s") * F.log("s")).alias("sum_s_log_s"),
            F.max(F.col("s") / F.col("tokens")).alias("rate"),
        )
        .orderBy("i")
        .collect()
    )
    out = []
    for r in summed:
        entropy = log(r["sum_s"]) - r["sum_s_log_s"] / r["sum_s"]
        repeats = r["rate"] * total * rules.budget_share / r["sum_s"]
        out.append((entropy / log(n) if n > 1 else 1.0, repeats))
    return out


def solve_exponent(sources: DataFrame, rules: MixRules) -> float:
    """Bisect the exponent; both conditions change in one direction along it."""

    def edge(holds) -> float:
        """Largest exponent where ``holds``, which ends somewhere on the way; 0 if nowhere."""
        low, high = 0.0, 1.0
        for turn in range(4):
            grid = [low + (high - low) * i / (_CUTS - 1) for i in range(_CUTS)]
            good = [holds(m) for m in _measures(sources, grid, rules)]
            if not good or (turn == 0 and all(good)):
                return 1.0
            if not good[0]:
                return low
            last = max(i for i, g in enumerate(good) if g)
            if last == _CUTS - 1:
                return high
            low, high = grid[last], grid[last + 1]
        return low

    wanted = edge(lambda m: m[0] >= rules.entropy - 1e-12)
    # Repetitions fall as the exponent grows, so the limit holds from some exponent on.
    over = edge(lambda m: m[1] > rules.most_repeats)
    at_wanted = _measures(sources, [wanted], rules)
    if at_wanted and at_wanted[0][1] > rules.most_repeats:
        return min(1.0, over + (_CUTS - 1.0) ** -4)
    return wanted


def source_weights(tokens: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """``source, tokens, docs, exponent, weight, quota, full_epochs, rest`` of each source."""
    sources = materialize(source_totals(tokens), "sources")
    exponent = solve_exponent(sources, rules)
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    powered = sources.withColumn("s", F.pow(F.col("tokens") / F.lit(total), F.lit(exponent)))
    norm = powered.agg(F.sum("s")).first()[0] or 1.0
    # Rounded, so that the order of sums does not matter.
    weight = F.round(F.col("s") / F.lit(norm), 12)
    quota = F.floor(weight * F.lit(total * rules.budget_share)).cast("long")
    return materialize(
        powered.select(
            "source", "tokens", "docs", F.lit(exponent).alias("exponent"),
            weight.alias("weight"), quota.alias("quota"),
        )
        .withColumn("full_epochs", F.floor(F.col("quota") / F.col("tokens")).cast("long"))
        .withColumn("rest", F.col("quota") - F.col("full_epochs") * F.col("tokens"))
        .withColumn(
            "n_blocks", F.ceil(F.col("tokens") / F.lit(rules.block_tokens)).cast("long")
        ),
        "weights",
    )


def _order(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def mix(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """The mixture: ``doc_id, source, n_tokens, epoch, block, block_order, doc_order, weight``.

    Sorting by epoch, ``block_order`` and ``doc_order`` gives the order of the blocks.
    """
    tokens = materialize(document_tokens(docs), "tokens")
    weights = source_weights(tokens, rules)
    same = F.col("source").eqNullSafe(F.col("w_source"))
    blocked = (
        tokens.join(weights.withColumnRenamed("source", "w_source"), same)
        .withColumn(
            "block", F.pmod(_order(rules.seed, "row_hash"), F.col("n_blocks")).cast("long")
        )
        .select(
            "doc_id", "source", "n_tokens", "row_hash", "weight", "full_epochs", "rest", "block"
        )
    )
    last = F.col("full_epochs").alias("epoch")
    sums = (
        blocked.where(F.col("rest") > 0)
        .groupBy("source", "block", "full_epochs", "rest")
        .agg(F.sum("n_tokens").alias("block_tokens"))
        .withColumn("block_order", _order(rules.seed, "source", "block", "full_epochs"))
    )
    running = Window.partitionBy("source").orderBy("block_order", "block")
    placed = sums.withColumn(
        "before", F.sum("block_tokens").over(running) - F.col("block_tokens")
    ).where(F.col("before") < F.col("rest"))
    placed = placed.select(
        F.col("source").alias("p_source"),
        F.col("block").alias("p_block"),
        (F.col("rest") - F.col("before")).alias("room"),
        (F.col("before") + F.col("block_tokens") <= F.col("rest")).alias("all_in"),
    )
    partial = blocked.where(F.col("rest") > 0).join(
        placed,
        F.col("source").eqNullSafe(F.col("p_source")) & (F.col("block") == F.col("p_block")),
    )
    whole_blocks = partial.where("all_in").select("*", last)
    within = Window.partitionBy("source", "block").orderBy("doc_order", "doc_id", "row_hash")
    cut = (
        partial.where(~F.col("all_in"))
        .select("*", last)
        .withColumn("doc_order", _order(rules.seed + 1, "row_hash", "epoch"))
        .withColumn("so_far", F.sum("n_tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("so_far") <= F.col("room"))
    )
    full = blocked.where(F.col("full_epochs") > 0).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full_epochs") - 1))
    )
    columns = ("doc_id", "source", "n_tokens", "row_hash", "epoch", "block", "weight")
    every = (
        full.select(*columns).unionByName(whole_blocks.select(*columns)).unionByName(cut.select(*columns))
    )
    return every.select(
        "doc_id",
        "source",
        "n_tokens",
        "epoch",
        "block",
        _order(rules.seed, "source", "block", "epoch").alias("block_order"),
        _order(rules.seed + 1, "row_hash", "epoch").alias("doc_order"),
        "weight",
    )
