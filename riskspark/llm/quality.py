"""Quality rules: rules on one document, and frequent lines across the documents of a host.

A line is normalised (lower case, no blanks around it), hashed, and counted once for each distinct
text of its host. Lines in more than ``max_line_docs`` texts of a host are removed; a document is
depleted, and rejected, if less than ``min_left`` of its characters remain. The limit is the same for
hosts of every size.

Near copies count as one text, so they do not make their own lines frequent. A text's five-word windows
are hashed once, and the least hash of each of ``BINS`` ranges is kept; two ranges in a row that
agree (in all of a few per cent of unrelated texts at most, in nearly all pairs that are 0.8
similar) make a text a follower of the smallest one. Only texts that follow none are counted.

Defined cases: a null text is an empty one, has no words and is rejected; a null host is a host of
its own; rows that share a doc_id are copies and judged alike; an empty table gives an empty result; other columns pass
through ``clean_documents`` unchanged, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.checksums import crc32_sql
from riskspark.llm.expressions import SPACES, let, whole, words_of
from riskspark.session import materialize

SYMBOL = "[#*$%&|<>]"
WINDOW = 5
#: Ranges of window hashes, of which each gives its least one to a text's sketch.
BINS = 32
#: A window's hash is a sum of its words' CRC-32 times these, modulo a prime of 61 bits.
FACTORS = (104_729_113, 152_041_247, 186_025_987, 220_000_049, 256_203_221)
PRIME = (1 << 61) - 1
_HALF = 1 << 31
#: Lines, keys (some 60 bytes each) or sketches (300) up to this number are sent to every task.
BROADCAST_LINES = 100_000


@dataclass(frozen=True)
class QualityRules:
    """Limits of the operator."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_line_docs: int = 20
    min_left: float = 0.1


def repeated_words(words: Column) -> Column:
    """Words inside windows of five that a text holds twice or more.

    Sorts the hashes of the windows with their places, keeps those with an equal
    neighbour, and adds up what each place covers before the next one.
    """

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, F.lit(1), F.size(hashes) - (WINDOW - 1)),
            lambda first, i: F.xxhash64(first, *(F.get(hashes, i + k) for k in range(1, WINDOW))),
        )

    def places(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            ordered,
            lambda o: F.sort_array(
                F.transform(
                    F.filter(
                        o,
                        lambda p, j: ((j > 0) & (F.get(o, j - 1)["h"] == p["h"]))
                        | F.coalesce(F.get(o, j + 1)["h"] == p["h"], F.lit(False)),
                    ),
                    lambda p: p["i"],
                )
            ),
        )

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    counted = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: let(
            windows(hashes),
            lambda found: F.when(
                F.size(F.array_distinct(found)) < F.size(found),
                let(places(found), covered),
            ).otherwise(F.lit(0).cast("long")),
        ),
    )
    return F.when(F.size(words) > WINDOW, counted).otherwise(F.lit(0).cast("long"))


def _with_word(lines: Column) -> Column:
    return F.filter(lines, lambda line: F.trim(line, F.lit(SPACES)) != "")


def _counts() -> Column:
    """The counts of the rules on one text, as a struct column."""
    text = whole("text")
    counted = let(
        words_of(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
        ),
    )
    lines = let(
        _with_word(F.split(text, "\n")), lambda x: F.size(x) - F.size(F.array_distinct(x))
    )
    return F.struct(
        counted.alias("w"),
        (F.size(F.split(text, SYMBOL)) - 1).cast("long").alias("n_symbols"),
        lines.cast("long").alias("n_dup_lines"),
    )


def _base_failed(n_words: Column, n_repeat_words: Column, rules: QualityRules) -> Column:
    return (n_words < rules.min_words) | (
        100 * n_repeat_words > rules.max_repeat_percent * n_words
    )


def document_rules(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``doc_id`` with the counts of the rules on one text, and ``base_failed``."""
    return docs.select("doc_id", _counts().alias("c")).select(
        "doc_id",
        F.col("c.w.n_words").alias("n_words"),
        F.col("c.w.word_chars").alias("word_chars"),
        F.col("c.n_symbols").alias("n_symbols"),
        F.col("c.n_dup_lines").alias("n_dup_lines"),
        F.col("c.w.n_repeat_words").alias("n_repeat_words"),
        _base_failed(F.col("c.w.n_words"), F.col("c.w.n_repeat_words"), rules).alias(
            "base_failed"
        ),
    )


def line_hash(line: Column) -> Column:
    """Hash of a normalised line."""
    return F.xxhash64(F.trim(F.lower(line), F.lit(SPACES)))


def text_hash(text: Column) -> Column:
    """The first 15 hexadecimal digits of the MD5 digest as a number, alike in other engines."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sketch(text: Column) -> Column:
    """The least window hash of each range, in order; none for under five words."""

    def hashes(numbers: Column) -> Column:
        return F.transform(
            F.slice(numbers, F.lit(1), F.size(numbers) - (WINDOW - 1)),
            lambda first, i: (
                first * FACTORS[0] + sum(F.get(numbers, i + k) * FACTORS[k] for k in range(1, WINDOW))
            ) % PRIME,
        )

    def bin_of(h: Column) -> Column:
        return F.shiftright(h, 61 - BINS.bit_length() + 1)

    def least(ordered: Column) -> Column:
        return F.filter(
            ordered, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(ordered, i - 1)))
        )

    def of_words(words: Column) -> Column:
        numbers = F.transform(words, lambda w: F.crc32(w.cast("binary")))
        found = let(numbers, lambda x: let(F.sort_array(hashes(x)), least))
        return F.when(F.size(words) >= WINDOW, found)

    none = F.array().cast("array<bigint>")
    return F.coalesce(let(words_of(text), of_words), none)


def _keys(first: Column) -> Column:
    """A key for each two neighbours of a sketch, the last and the first included."""
    return F.transform(
        first,
        lambda h, i: (h % _HALF) * _HALF + F.coalesce(F.get(first, i + 1), F.get(first, F.lit(0))) % _HALF,
    )


def followers(docs: DataFrame) -> DataFrame:
    """``host, no_host, text_hash`` of texts with a near copy of a smaller hash in their host."""
    text, host = whole("text"), ["host", "no_host"]
    texts = materialize(
        docs.select(*_host(), text_hash(text).alias("text_hash"), sketch(text).alias("sketch"))
        .dropDuplicates([*host, "text_hash"]),
        "sketches",
    )
    rows = texts.select(*host, "text_hash", F.explode(_keys(F.col("sketch"))).alias("key"))
    shared = (
        rows.groupBy(*host, "key")
        .agg(F.min("text_hash").alias("first"), F.max("text_hash").alias("last"))
        .where(F.col("first") < F.col("last"))
        .drop("last")
    )
    pairs = (
        rows.join(_sent(materialize(shared, "shared-keys")), [*host, "key"])
        .where(F.col("text_hash") > F.col("first"))
        .select(*host, "text_hash", "first")
        .distinct()
    )
    firsts = texts.select(*host, F.col("text_hash").alias("first"), F.col("sketch").alias("other")).join(
        shared.select(*host, "first").distinct(), [*host, "first"], "left_semi"
    )
    agree = 2 * F.size(F.array_intersect("sketch", "other"))
    return (
        pairs.join(texts, [*host, "text_hash"])
        .join(_sent(materialize(firsts, "first-sketches")), [*host, "first"])
        .where(agree >= F.greatest(F.size("sketch"), F.size("other")))
        .select(*host, "text_hash")
        .distinct()
    )


def _sent(stored: DataFrame) -> DataFrame:
    """A stored table that goes to every task if it has few rows, and is shuffled otherwise."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_LINES else stored


def _host() -> tuple[Column, Column]:
    return (
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
        F.col("source").isNull().alias("no_host"),
    )


def _lines(docs: DataFrame) -> DataFrame:
    """A row for each line with a word: its hash and characters."""
    text = whole("text")
    hashed = F.transform(
        _with_word(F.split(text, "\n")),
        lambda line: F.struct(
            line_hash(line).alias("line_hash"), F.length(line).alias("line_chars")
        ),
    )
    return docs.select(
        "doc_id",
        *_host(),
        text_hash(text).alias("text_hash"),
        F.length(text).alias("text_chars"),
        hashed.alias("lines"),
    ).select("*", F.posexplode("lines").alias("place", "line")).select(
        "doc_id", "host", "no_host", "text_hash", "text_chars", "place",
        "line.line_hash", "line.line_chars",
    )


def frequent_lines(docs: DataFrame, stored: DataFrame, rules: QualityRules) -> DataFrame:
    """``host, no_host, line_hash`` of lines in too many distinct texts of a host.

    ``stored`` has the lines of ``docs``.
    """
    line = ["host", "no_host", "line_hash"]

    def often(lines: DataFrame) -> DataFrame:
        counted = lines.groupBy(*line).agg(F.count(F.lit(1)).alias("n_docs"))
        return counted.where(F.col("n_docs") > rules.max_line_docs)

    lines = stored.select(*line, "text_hash").distinct()
    many = _sent(materialize(often(lines).drop("n_docs"), "candidate-lines"))
    # Only lines in enough texts can be in enough texts that follow none.
    left = lines.join(many, line, "left_semi")
    counted = often(left.join(followers(docs), ["host", "no_host", "text_hash"], "left_anti"))
    return counted.drop("n_docs")


def removed_lines(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """A row for each document that loses lines: their hashes, number and characters."""
    lines = materialize(_lines(docs), "lines")
    frequent = _sent(materialize(frequent_lines(docs, lines, rules), "frequent-lines"))
    return (
        lines.drop("text_hash")
        .join(frequent, ["host", "no_host", "line_hash"])
        .distinct()  # rows that share a doc_id are copies
        .groupBy("doc_id")
        .agg(
            F.count(F.lit(1)).alias("n_lines_removed"),
            F.sum("line_chars").alias("n_chars_removed"),
            F.max("text_chars").alias("text_chars"),
            F.collect_set("line_hash").alias("line_hashes"),
        )
    )


def _depleted(n_chars_removed: Column, text_chars: Column, rules: QualityRules) -> Column:
    return text_chars - n_chars_removed < rules.min_left * text_chars


def quality(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The counts of each document, what frequent lines take from it, and ``kept``."""
    removed = removed_lines(docs, rules).select(
        "doc_id",
        "n_lines_removed",
        "n_chars_removed",
        _depleted(F.col("n_chars_removed"), F.col("text_chars"), rules).alias("depleted"),
    )
    nothing = {"n_lines_removed": 0, "n_chars_removed": 0, "depleted": False}
    return (
        document_rules(docs, rules)
        .join(removed, "doc_id", "left")
        .na.fill(nothing)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
    )


def clean_documents(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The kept documents without their frequent lines, in the columns of ``docs``.

    Texts that lose nothing stay byte for byte; ``n_chars`` follows a changed text.
    """
    gone = removed_lines(docs, rules).select(
        F.col("doc_id").alias("__quality_id"),
        F.col("line_hashes").alias("__quality_hashes"),
        _depleted(F.col("n_chars_removed"), F.col("text_chars"), rules).alias("__quality_low"),
    )
    hashes, text = F.col("__quality_hashes"), whole("text")
    words = let(
        words_of(text),
        lambda w: _base_failed(F.size(w).cast("long"), repeated_words(w), rules),
    )
    shorter = F.concat_ws(
        "\n",
        F.filter(
            F.split(text, "\n"),
            lambda line: (F.trim(line, F.lit(SPACES)) == "")
            | ~F.array_contains(hashes, line_hash(line)),
        ),
    )
    changed = hashes.isNotNull()
    joined = (
        docs.where(~words)
        .join(gone, F.col("doc_id") == F.col("__quality_id"), "left")
        .where(~F.coalesce("__quality_low", F.lit(False)))
        .withColumn("__quality_text", F.when(changed, shorter).otherwise(F.col("text")))
    )
    out = []
    for name in docs.columns:
        column = F.col(f"`{name}`")
        if name == "text":
            column = F.col("__quality_text")
        elif name == "n_chars":
            size = F.length("__quality_text").cast(docs.schema[name].dataType)
            column = F.when(changed, size).otherwise(column)
        out.append(column.alias(name))
    return joined.select(*out)


_WINDOW_SQL = " + ".join(f"ns[i + {k}] * {f}" for k, f in enumerate(FACTORS))
ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, CAST('0x' || substr(md5(text), 1, 15) AS BIGINT) AS th,
        regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, string_split(text, chr(10)) AS ls FROM d),
c AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
        list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS good FROM w),
g AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS p, words FROM w WHERE len(words) >= 5),
h AS (SELECT doc_id, p, list_slice(words, p, p + 4) AS gram FROM g),
k AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM h),
r AS (SELECT doc_id, count(DISTINCT q) AS n_repeat FROM
       (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM k WHERE n > 1) GROUP BY doc_id),
ln AS (SELECT doc_id, source, th, length(text) AS tc, unnest(ls) AS line FROM w),
nl AS (SELECT doc_id, source, th, tc, length(line) AS lc,
        trim(lower(line), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS norm
       FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
sw AS (SELECT coalesce(source, '') AS host, source IS NULL AS no_host, th, any_value(list_transform(words,
        lambda x: @CRC@)) AS ns FROM w WHERE len(words) >= 5 GROUP BY ALL),
sh AS (SELECT host, no_host, th, unnest(list_transform(range(1, len(ns) - 3), lambda i: (@WINDOW@) % @PRIME@)) AS g FROM sw),
sb AS (SELECT host, no_host, th, min(g) AS g FROM sh GROUP BY host, no_host, th, g >> @SHIFT@),
sk AS (SELECT host, no_host, th, (g % @HALF@) * @HALF@ + coalesce(lead(g) OVER o, first_value(g) OVER o) % @HALF@ AS key
       FROM sb WINDOW o AS (PARTITION BY host, no_host, th ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
sf AS (SELECT host, no_host, key, min(th) AS first FROM sk GROUP BY ALL),
cd AS (SELECT DISTINCT host, no_host, th, first FROM sk JOIN sf USING (host, no_host, key) WHERE th > first),
sn AS (SELECT host, no_host, th, count(*) AS n FROM sb GROUP BY ALL),
eq AS (SELECT host, no_host, cd.th, first, count(*) AS k FROM cd JOIN sb a USING (host, no_host, th)
       JOIN sb b USING (host, no_host, g) WHERE b.th = first GROUP BY ALL),
fo AS (SELECT DISTINCT host, no_host, eq.th FROM eq JOIN sn x USING (host, no_host, th)
       JOIN sn y USING (host, no_host) WHERE y.th = first AND 2 * k >= greatest(x.n, y.n)),
f AS (SELECT nl.source, norm FROM nl ANTI JOIN fo
       ON fo.host = coalesce(nl.source, '') AND fo.no_host = (nl.source IS NULL) AND fo.th = nl.th
       GROUP BY nl.source, norm HAVING count(DISTINCT th) > 20),
t AS (SELECT doc_id, count(*) AS nr, sum(lc) AS lr, max(tc) AS tc FROM nl JOIN f
       ON nl.source IS NOT DISTINCT FROM f.source AND nl.norm = f.norm GROUP BY doc_id),
x AS (SELECT c.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
        CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(good) - len(list_distinct(good)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(nr, 0) AS BIGINT) AS n_lines_removed,
        CAST(coalesce(lr, 0) AS BIGINT) AS n_chars_removed,
        (n_words < 10 OR 100 * coalesce(n_repeat, 0) > 20 * n_words) AS base_failed,
        coalesce(tc - lr < 0.1 * tc, false) AS depleted
       FROM c LEFT JOIN r USING (doc_id) LEFT JOIN t USING (doc_id))
SELECT *, (NOT base_failed AND NOT depleted) AS kept FROM x
""".replace("@WINDOW@", _WINDOW_SQL).replace("@CRC@", crc32_sql("x")).replace("@PRIME@", str(PRIME)).replace("@HALF@", str(_HALF)).replace(
    "@SHIFT@", str(61 - BINS.bit_length() + 1)
)
