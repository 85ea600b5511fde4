"""Licence scan: exact set-similarity join of text blocks with licence templates.

A text's words are cut into overlapping blocks. A template is found in a block that holds at least
``threshold`` of its different words. The join is exact and spares nearly all pairs:

* words are put in one global order, from the rarest to the most frequent over all documents;
* prefix filter: a match must share one of the first ``size - need + 1`` words of the template, and
  of the block's own template words, in that order;
* length filter: the block holds at least ``need`` template words;
* positional filter: what can follow the shared word, on both sides, must reach ``need``;
* the pairs that are left are counted in full.

Besides, ``phrase_places`` finds every place where the words of a phrase stand consecutively.

Defined cases: a null text is an empty one; a document without matches has null places, empty labels
and score 0; repeated rows are scanned alike; an empty table gives an empty result; labels are
distinct and sorted; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.expressions import ascii_lower, let, whole

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases of the contract and opening words of public licences.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
TEMPLATES = (
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version"),
    (
        "gpl",
        "redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation",
    ),
    ("mpl", "subject to the terms of the mozilla public license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("reserved", "all rights reserved"),
)


@dataclass(frozen=True)
class LicenceScan:
    """Parameters: blocks of ``block`` words start every ``step`` words."""

    threshold: float = 0.9
    block: int = 32
    step: int = 8
    phrases: tuple = PHRASES
    templates: tuple = TEMPLATES
    sizes: tuple = field(init=False)

    def __post_init__(self):
        sets = tuple(tuple(dict.fromkeys(text.split())) for _, text in self.templates)
        if any(len(s) > self.block - self.step + 1 for s in sets):
            raise ValueError("a template is longer than the overlap of two blocks")
        object.__setattr__(self, "sizes", sets)

    def need(self, size: int) -> int:
        return max(1, math.ceil(self.threshold * size - 1e-9))

    @property
    def vocabulary(self) -> list[str]:
        return sorted({w for s in self.sizes for w in s})


def licence_words(text: Column) -> Column:
    """Runs of letters, digits and characters beyond ASCII."""

    def inner(cut: Column) -> Column:
        first = (F.get(cut, F.lit(0)) == "").cast("int")
        last = ((F.size(cut) > 1) & (F.element_at(cut, -1) == "")).cast("int")
        return F.slice(cut, first + 1, F.size(cut) - first - last)

    return let(F.split(text, SEPARATORS), inner)


def _holds_any(text: Column, words: list[str]) -> Column:
    """True for every text with one of the words; also for some without."""
    low, found = F.lower(text), F.lit(False)
    for word in words:
        found = found | F.contains(low, F.lit(word))
    return found


def word_order(docs: DataFrame, scan: LicenceScan) -> list[str]:
    """The templates' words from the rarest to the most frequent over all documents.

    As many rows as the templates have words reach the driver.
    """
    words = licence_words(F.lower(whole("text")))
    counts = (
        docs.select(F.filter(words, lambda w: w.isin(scan.vocabulary)).alias("w"))
        .select(F.explode("w").alias("w"))
        .groupBy("w")
        .count()
    )
    seen = {r["w"]: r["count"] for r in counts.collect()}
    return sorted(scan.vocabulary, key=lambda w: (seen.get(w, 0), w))


def _rarest(scan: LicenceScan, rank: dict[str, int]) -> list[tuple]:
    """Template prefixes: (template, label, word rank, place, size, need)."""
    rows = []
    for number, ((label, _), words) in enumerate(zip(scan.templates, scan.sizes, strict=True)):
        need = scan.need(len(words))
        ranks = sorted(rank[w] for w in words)
        rows += [
            (number, label, r, place, len(words), need)
            for place, r in enumerate(ranks[: len(words) - need + 1])
        ]
    return rows


def _blocks_of(at: Column, scan: LicenceScan) -> Column:
    """Numbers of the blocks that hold the word at a place."""
    first = F.ceil((at - (scan.block - 1)) / scan.step).cast("int")
    return F.sequence(F.greatest(F.lit(0), first), F.floor(at / scan.step).cast("int"))


def block_matches(docs: DataFrame, scan: LicenceScan = LicenceScan()) -> DataFrame:
    """``doc_id, start, n_words, label, template, containment`` of every matching block."""
    spark = docs.sparkSession
    order = word_order(docs, scan)
    rank = {w: i for i, w in enumerate(order)}
    prefix = _rarest(scan, rank)
    rare = sorted({order[r[2]] for r in prefix})
    least = min(scan.need(len(s)) for s in scan.sizes)
    ranks = F.create_map(*(F.lit(x) for w, r in rank.items() for x in (w, r)))

    words = licence_words(ascii_lower(whole("text")))
    # A block that holds no word of a template's prefix can't match.
    touched = let(
        words,
        lambda w: F.struct(
            w.alias("words"),
            F.filter(
                F.transform(w, lambda x, i: F.when(x.isin(rare), i)), lambda i: i.isNotNull()
            ).alias("at"),
        ),
    )
    found = docs.where(_holds_any(whole("text"), rare)).select("doc_id", touched.alias("t"))
    spans = (
        found.select("doc_id", F.col("t.words").alias("words"), F.col("t.at").alias("ats"))
        .select(
            "doc_id",
            "words",
            F.array_distinct(
                F.flatten(
                    F.transform("ats", lambda at: _blocks_of(at, scan))
                )
            ).alias("numbers"),
        )
        .select(
            "doc_id",
            F.explode(
                F.transform(
                    "numbers",
                    lambda b: F.struct(
                        (b * scan.step).alias("start"),
                        F.slice("words", b * scan.step + 1, scan.block).alias("words"),
                    ),
                )
            ).alias("b"),
        )
    )
    ranked = F.sort_array(
        F.array_distinct(
            F.transform(
                F.filter("b.words", lambda w: w.isin(scan.vocabulary)),
                lambda w: F.element_at(ranks, w),
            )
        )
    )
    blocks = (
        spans.select(
            "doc_id",
            F.col("b.start").alias("start"),
            F.size("b.words").alias("n_words"),
            ranked.alias("ranks"),
        )
        .withColumn("size", F.size("ranks"))
        .where(F.col("size") >= least)
        .select(
            "*",
            F.posexplode(F.slice("ranks", F.lit(1), F.col("size") - (least - 1))).alias(
                "block_place", "rank"
            ),
        )
    )
    prefixes = spark.createDataFrame(
        prefix, "template int, label string, rank int, place int, t_size int, need int"
    )
    candidates = (
        blocks.join(F.broadcast(prefixes), "rank")
        .where(
            (F.col("size") >= F.col("need"))
            & (F.col("block_place") <= F.col("size") - F.col("need"))
            & (
                F.least(F.col("t_size") - F.col("place"), F.col("size") - F.col("block_place"))
                >= F.col("need")
            )
        )
        .select("doc_id", "start", "n_words", "ranks", "template", "label", "t_size", "need")
    )
    full = spark.createDataFrame(
        [(i, [rank[w] for w in s]) for i, s in enumerate(scan.sizes)],
        "template int, t_ranks array<int>",
    )
    common = F.size(F.array_intersect("ranks", "t_ranks"))
    return (
        candidates.join(F.broadcast(full), "template")
        .withColumn("common", common)
        .where(F.col("common") >= F.col("need"))
        .select(
            "doc_id", "start", "n_words", "label", "template",
            (F.col("common") / F.col("t_size")).alias("containment"),
        )
    )


def phrase_places(words: Column, phrases: tuple = PHRASES) -> Column:
    """Array of (label, start) of all places where a phrase's words stand consecutively."""

    def starts(words: Column, label: str, text: str) -> Column:
        parts = text.split()
        place = F.transform(
            words,
            lambda w, i: F.when(
                (w == parts[0]) & (F.slice(words, i + 1, len(parts)) == F.array(*map(F.lit, parts))),
                F.struct(F.lit(label).alias("label"), i.alias("start")),
            ),
        )
        return F.filter(place, lambda p: p.isNotNull())

    return let(
        words, lambda w: F.concat(*(starts(w, label, text) for label, text in phrases))
    )


def scan_documents(docs: DataFrame, scan: LicenceScan = LicenceScan()) -> DataFrame:
    """One row for each document: places of the phrases, labels of both ways, and a score."""
    text = whole("text")
    longest = sorted({max(p.split(), key=len) for _, p in scan.phrases})
    none = F.array().cast("array<struct<label:string,start:int>>")
    places = F.when(
        _holds_any(text, longest), phrase_places(licence_words(ascii_lower(text)), scan.phrases)
    )
    base = docs.select(
        "doc_id",
        F.size(licence_words(text)).cast("long").alias("n_words"),
        F.coalesce(places, none).alias("places"),
    )
    found = (
        block_matches(docs, scan)
        .groupBy("doc_id")
        .agg(
            F.collect_set("label").alias("found"),
            F.max("containment").alias("score"),
            F.count_distinct("start").alias("n_blocks"),
        )
    )
    labels = F.col("places.label")
    both = F.array_union(F.array_distinct(labels), F.coalesce("found", F.array().cast("array<string>")))
    starts = F.col("places.start")
    return base.join(found, "doc_id", "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("score", F.lit(0.0))).alias(
            "score"
        ),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
    )


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(x) for x in row) + ")" for row in rows)


def oracle_sql(scan: LicenceScan = LicenceScan()) -> str:
    """Every block against every template, without filters."""
    templates = _values(
        (i, label, " ".join(words), len(words), scan.need(len(words)))
        for i, ((label, _), words) in enumerate(zip(scan.templates, scan.sizes, strict=True))
    )
    phrases = _values((label, text, len(text.split())) for label, text in scan.phrases)
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
ph AS (SELECT * FROM (VALUES {phrases}) v(label, phrase, n)),
tp AS (SELECT template, label, string_split(t, ' ') AS tw, size, need
       FROM (VALUES {templates}) v(template, label, t, size, need)),
pos AS (SELECT doc_id, words, unnest(range(len(words))) AS p FROM d WHERE len(words) > 0),
pl AS (SELECT doc_id, label, p FROM pos JOIN ph
       ON array_to_string(list_slice(words, p + 1, p + n), ' ') = phrase),
b AS (SELECT doc_id, count(*) AS n, min(p) AS f, max(p) AS l FROM pl GROUP BY doc_id),
bl AS (SELECT doc_id, p, list_slice(words, p + 1, p + {scan.block}) AS bw FROM pos WHERE p % {scan.step} = 0),
m AS (SELECT doc_id, p, label, len(list_intersect(bw, tw)) / size AS containment
      FROM bl, tp WHERE len(list_intersect(bw, tw)) >= need),
ms AS (SELECT doc_id, max(containment) AS score, count(DISTINCT p) AS n_blocks FROM m GROUP BY doc_id),
lb AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM
       (SELECT DISTINCT doc_id, label FROM (SELECT doc_id, label FROM pl UNION ALL SELECT doc_id, label FROM m)) GROUP BY doc_id),
bb AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS base_labels FROM
       (SELECT DISTINCT doc_id, label FROM pl) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
  CAST(b.f AS BIGINT) AS first_word, CAST(b.l AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0::DOUBLE) END AS score,
  CAST(coalesce(n_blocks, 0) AS BIGINT) AS n_blocks
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN ms USING (doc_id) LEFT JOIN lb USING (doc_id) LEFT JOIN bb USING (doc_id)
"""
