"""Spelling variants: words one edit apart, found in a bit-sliced position index.

Two words one edit apart agree before the edit and, aligned at their ends, after it. So each word
is dealt to blocks: for the longer length of a pair and a span of places [lo, hi), all words with
the same letters before ``lo`` and after ``hi``. Spans start as halves; a block of over ``BLOCK`` words
is replaced by those of its half spans until it is small, which it is at one place at the latest
(one word for each letter). A pair belongs to the one span of its first difference.

Within a block the words of the longer length are bits. The index holds a bit set for each (place,
letter); a query runs through its letters once and keeps two sets, the words with no error so far
and those with one, by word-parallel recurrences. For a query that is a letter shorter, the set with one
error looks at the places shifted by one. No pair is listed: a block returns a count and the best
neighbour for each word.

Forms have at least twice the count, so chains are short; roots come from pointer doubling.

Defined cases: a null text has no words; rows that share a doc_id are separate occurrences; a null
doc_id is written as nothing in the checksum; repeated rows count again; texts are read in pieces that
end between words, so length is no limit; ties go to the smallest word; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.checksums import crc32_sql
from riskspark.session import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOW = str.maketrans(_UPPER, _UPPER.lower())
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_NO_RUN = re.compile("[^A-Za-zÀ-ÿ]")
#: Characters read at once, and words a task counts before it passes them on.
_PIECE, _HELD = 1 << 20, 200_000
#: Words of a block beyond which its span is halved.
BLOCK = 2048
#: Blocks to halve, up to this number, are named to every task (some 60 bytes each).
BROADCAST_BLOCKS = 100_000

c = F.col


@dataclass(frozen=True)
class SpellingRules:
    """Least letters and occurrences of a word; one in ``dropping`` runs loses a letter (0: none)."""

    letters: int = 5
    occurrences: int = 3
    dropping: int = 97


def runs_of(text: str):
    """Counts of the letter runs of a text, A-Z in lower case."""
    counted, at = Counter(), 0
    while at < len(text):
        stop = min(at + _PIECE, len(text))
        cut = _NO_RUN.search(text, stop)
        stop = len(text) if cut is None else cut.start()
        counted.update(_RUN.findall(text, at, stop))
        at = stop + 1
    low = defaultdict(int)
    for run, n in counted.items():
        low[run.lower() if run.isascii() else run.translate(_LOW)] += n
    return low


def vocabulary(docs: DataFrame, rules: SpellingRules = SpellingRules()) -> DataFrame:
    """``word, n``: the words of all texts and how often they occur."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        held: dict[str, int] = defaultdict(int)

        def passed():
            words = [w for w in held if len(w) >= rules.letters]
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())], schema=schema
            )
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in runs_of(text.as_py() or "").items():
                    if rules.dropping:
                        h = zlib.crc32(word.encode(), begun)
                        if h % rules.dropping == 0:
                            gone = h % len(word)
                            word = word[:gone] + word[gone + 1 :]
                    held[word] += n
                if len(held) >= _HELD:
                    yield passed()
        yield passed()

    rows = docs.select("doc_id", c("text").cast("string").alias("text"))
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(c("n") >= rules.occurrences)


def _block(size: Column, lo: Column, hi: Column) -> Column:
    """The name of a block: length of the longer words, span, letters before and after it."""
    after = F.when(size > hi, F.substring("word", F.length("word") - (size - hi) + 1, size - hi))
    return F.concat_ws(
        ",", size.cast("string"), lo.cast("string"), hi.cast("string"),
        F.substring("word", F.lit(1), lo), F.coalesce(after, F.lit("")),
    )


def _halves(rows: DataFrame, size: Column, lo: Column, hi: Column) -> DataFrame:
    middle = F.floor((lo + hi) / 2).cast("int")
    spans = F.explode(
        F.array(F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi")))
    )
    split = rows.select("word", "n", size.alias("size"), spans.alias("s")).where("s.lo < s.hi")
    at = (c("size"), c("s.lo"), c("s.hi"))
    return split.select("word", "n", "size", "s.lo", "s.hi", _block(*at).alias("block"))


def blocks(words: DataFrame, most: int = BLOCK) -> list[DataFrame]:
    """Tables of ``word, n, size, lo, hi, block`` whose blocks hold ``most`` words at most.

    Each pair of words one edit apart shares the one block of its first difference.
    """
    length = F.length("word")
    sized = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("size"))
    now = materialize(_halves(sized, c("size"), F.lit(0), c("size")), "spelling-blocks")
    done = []
    while True:
        large = materialize(
            now.where(c("hi") - c("lo") > 1)
            .groupBy("block").agg(F.count(F.lit(1)).alias("k")).where(c("k") > most).select("block"),
            "spelling-large",
        )
        few = large.count()
        if not few:
            return [*done, now]
        named = F.broadcast(large) if few <= BROADCAST_BLOCKS else large
        done.append(now.join(named, "block", "left_anti"))
        parents = now.join(named, "block", "left_semi")
        now = materialize(_halves(parents, c("size"), c("lo"), c("hi")), "spelling-blocks")


def _bits(found: int):
    while found:
        lowest = found & -found
        yield lowest.bit_length() - 1
        found ^= lowest


def near_in_block(size: int, lo: int, hi: int, words: list[tuple[str, int]]):
    """(word, neighbours, largest count of one, that neighbour) for the words of one block."""
    indexed = [(w, n) for w, n in words if len(w) == size]
    shorter = [(w, n) for w, n in words if len(w) < size]
    index: list[dict[str, int]] = [defaultdict(int) for _ in range(hi - lo)]
    for i, (word, _) in enumerate(indexed):
        bit = 1 << i
        for place, letter in zip(index, word[lo:hi], strict=True):
            place[letter] |= bit
    everything = (1 << len(indexed)) - 1
    found: dict[str, list] = {}

    def tell(word, other, n):
        said = found.get(word)
        if said is None:
            found[word] = [1, n, other]
        else:
            said[0] += 1
            if n > said[1] or (n == said[1] and other < said[2]):
                said[1:] = n, other

    for word, _ in indexed if len(indexed) > 1 else ():
        none, one = everything, 0
        for place, letter in zip(index, word[lo:hi], strict=True):
            same = place[letter]
            one = (one & same) | (none & ~same)
            none &= same
        for i in _bits(one):
            tell(word, *indexed[i])
    for word, n in shorter if indexed else ():
        none, one = everything, 0
        for j in range(lo, hi - 1):
            letter = word[j]
            one = (one | none) & index[j - lo + 1].get(letter, 0)
            none &= index[j - lo].get(letter, 0)
        one |= none
        if hi < size:  # a first difference beyond the span belongs to another block
            one &= ~(none & index[-1].get(word[hi - 1], 0))
        for i in _bits(one):
            tell(word, *indexed[i])
            tell(indexed[i][0], word, n)
    return [(word, *said) for word, said in found.items()]


def neighbours(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """``word, n_near, best_n, best``: how many words are one edit away, and the most frequent."""
    schema = pa.schema(
        [("word", pa.string()), ("k", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]
    )

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(x).to_pylist() for x in ("block", "word", "n")), strict=True)

        ready = []
        for block, members in groupby(rows(), key=lambda r: r[0]):
            held = [(word, n) for _, word, n in members]
            if len(held) > 1:
                ready += near_in_block(*(int(x) for x in block.split(",", 3)[:3]), held)
            if len(ready) >= 10_000:
                yield _batch(ready, schema)
                ready.clear()
        if ready:
            yield _batch(ready, schema)

    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = [
        part.select("block", "word", "n").repartition(tasks, "block").sortWithinPartitions("block")
        .mapInArrow(run, "word string, k long, best_n long, best string")
        for part in blocks(words, most)
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.min(F.struct((-c("best_n")).alias("m"), c("best").alias("w")))
    summed = found.groupBy("word").agg(F.sum("k").alias("n_near"), best.alias("b"))
    return summed.select("word", "n_near", (-c("b.m")).alias("best_n"), c("b.w").alias("best"))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema
    )


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` from stored ``word, form`` without cycles, by pointer doubling.

    The pointers that a round still moves are counted, so the rounds are the logarithm of the
    longest chain.
    """
    now = links.select("word", c("form").alias("root"))
    while True:
        further = now.select(c("word").alias("root"), c("root").alias("next"))
        moved = materialize(
            now.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), c("next").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, rules: SpellingRules = SpellingRules(), most: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    words = materialize(vocabulary(docs, rules), "spelling-words")
    near = neighbours(words, most)
    formed = c("best_n") >= 2 * c("n")
    judged = materialize(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, c("best")).alias("form"), F.when(formed, c("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    rooted = roots(judged.where(c("form").isNotNull()).select("word", "form"))
    return judged.join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def oracle_sql(rules: SpellingRules = SpellingRules()) -> str:
    """Words that share a string with one letter left out, and a recursive walk to the root."""
    return rf"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
g AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id, translate(run, '{_UPPER}', '{_UPPER.lower()}') AS run,
        count(*) AS n FROM r GROUP BY ALL),
h AS (SELECT run, n, {crc32_sql("doc_id || ':' || run")} AS h FROM g),
w AS (SELECT CASE WHEN h % {rules.dropping} = 0
        THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
        CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY 1),
v AS MATERIALIZED (SELECT word, n FROM w WHERE length(word) >= {rules.letters} AND n >= {rules.occurrences}),
i AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
d AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM i),
p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM d a JOIN d b USING (rest, i) WHERE a.word <> b.word
  UNION SELECT d.word, d.n, v.word, v.n FROM d JOIN v ON v.word = rest
  UNION SELECT v.word, v.n, d.word, d.n FROM d JOIN v ON v.word = rest),
o AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place,
        count(*) OVER (PARTITION BY word) AS n_near FROM p),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN near_n >= 2 * v.n THEN near END AS form, CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
      FROM v LEFT JOIN o ON o.word = v.word AND place = 1),
walk AS (SELECT word, word AS here, 0 AS step FROM f
  UNION ALL SELECT walk.word, f.form, step + 1 FROM walk JOIN f ON f.word = walk.here WHERE f.form IS NOT NULL),
z AS (SELECT word, arg_max(here, step) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM f JOIN z USING (word)
"""
