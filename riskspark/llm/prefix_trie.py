"""The trie of conversation prefixes, from union-find over sorted neighbours.

A turn is 16 bytes of the SHA-256 digest of its role and text, a conversation the string of its
turns. Distinct conversations are range-sorted; the longest common prefix (LCP) of two neighbours is
an edge. A task takes the edges of its range in descending depth and unites their sides: what is
united at a depth is one branching node, and the nodes without branches between it and its children
are written as the children's chains. A component carries sums only (members, leaves, words saved),
so nothing is visited twice.

Nodes on a range's first and last path may go on in the ranges beside it. Tasks learn the LCP at
their borders (two keys for each partition pass the driver) and hand such nodes over as sums by
prefix digest; Spark adds these up, which merges the contracted forests whatever number of ranges
a node spans.

Bounds: a conversation is one row of 20 bytes a turn; partitions follow the bytes of the keys; copies
of a conversation are one row, and the digest of their ids, which is sequential, streams through a
sorted partition.

Defined cases: a null role or text is empty; turns are taken by ``turn`` (nulls first), ties by digest,
repeated rows as repeated turns; rows without a conv_id belong to no conversation and are left out;
conversations without turns are members of the root; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.checksums import crc32_sql
from riskspark.llm.expressions import whole, words_of
from riskspark.session import checkpointed, materialize

UNIT = 16
#: Conversations that share the head of their first one, and the number of different head lengths.
FAMILY, HEADS = 20, 4
#: Bytes of keys that a task sorts into its forest.
TASK_BYTES = 8 << 20
#: Handed-over nodes (some 60 bytes each) up to this number are sent to every task.
BROADCAST_NODES = 200_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

c = F.col


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: an array of (digest, words) for each conversation, in order."""
    role, text = whole("role"), whole("text")
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where(c("conv_id").isNotNull()).select(
        c("conv_id").cast("long").alias("conv_id"),
        F.struct(
            c("turn").isNotNull().alias("numbered"),
            F.coalesce(c("turn").cast("long"), F.lit(0)).alias("turn"),
            F.substring(said, 1, 2 * UNIT).alias("digest"),
            F.size(words_of(text)).alias("words"),
        ).alias("t"),
    )
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    plain = F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return grouped.select("conv_id", plain.alias("turns"))


def with_family_heads(seqs: DataFrame) -> DataFrame:
    """Replace the first turns of each conversation by those of the first one of its family.

    How many depends on the checksum of the id, so families share heads of several lengths.
    """
    n = F.pmod(F.crc32(c("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    first = seqs.where(c("conv_id") % FAMILY == 0).select(
        c("conv_id").alias("family"), F.slice("turns", 1, HEADS - 1).alias("head")
    )
    family = c("conv_id") - c("conv_id") % FAMILY
    rows = seqs.withColumns({"n": n, "family": family}).join(first, "family", "left")
    head = F.coalesce(F.slice("head", F.lit(1), c("n")), F.slice("turns", 1, 0))
    rest = F.slice("turns", c("n") + 1, F.greatest(F.size("turns") - c("n"), F.lit(0)))
    return rows.select("conv_id", F.concat(head, rest).alias("turns"))


def _key(turns: str) -> Column:
    return F.unhex(F.array_join(F.transform(turns, lambda t: t["digest"]), ""))


def _distinct(seqs: DataFrame) -> DataFrame:
    """``key, words, n, conv, ends`` of each distinct sequence, its members streamed in order."""
    stored = materialize(
        seqs.select("conv_id", _key("turns").alias("key"), c("turns.words").alias("words")),
        "conversations",
    )
    schema = pa.schema(
        [("conv", pa.int64()), ("n", pa.int64()), ("ends", pa.string())]
    )

    def run(batches):
        now, first, n, digest, ready = None, None, 0, None, []
        for batch in batches:
            for key, conv in zip(*(batch.column(x).to_pylist() for x in ("digest", "conv_id")), strict=True):
                if key != now:
                    if now is not None:
                        ready.append({"conv": first, "n": n, "ends": digest.hexdigest()})
                    now, first, n, digest = key, conv, 0, hashlib.sha256()
                digest.update(f",{conv}".encode() if n else str(conv).encode())
                n += 1
            if len(ready) >= 5000:
                yield pa.RecordBatch.from_pylist(ready, schema=schema)
                ready.clear()
        if now is not None:
            ready.append({"conv": first, "n": n, "ends": digest.hexdigest()})
        yield pa.RecordBatch.from_pylist(ready, schema=schema)

    members = stored.select(F.sha2("key", 256).alias("digest"), "conv_id")
    tasks = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = members.repartition(tasks, "digest").sortWithinPartitions("digest", "conv_id")
    groups = ordered.mapInArrow(run, "conv long, n long, ends string")
    return stored.join(groups, c("conv_id") == c("conv")).drop("conv_id")


def shared_units(a: bytes, b: bytes) -> int:
    """The number of turns that two keys have in common at their start."""
    low, high = 0, min(len(a), len(b)) // UNIT
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * UNIT] == b[: middle * UNIT]:
            low = middle
        else:
            high = middle - 1
    return low


def _prefix_ids(key: bytes, depth: int) -> list[bytes]:
    """A digest of each prefix of 0 to ``depth`` turns."""
    digest, out = hashlib.blake2b(digest_size=16), []
    for d in range(depth + 1):
        out.append(digest.digest())
        digest.update(key[d * UNIT : (d + 1) * UNIT])
    return out


class _Part:
    """A component of the forest: the members of one node, and what waits for its id."""

    __slots__ = ("bottom", "n", "spent", "conv", "leaves", "children", "ends", "waiting", "first", "last", "sums")

    def __init__(self, depth, n, spent, conv, leaf, ends, first, last, sums):
        self.bottom, self.n, self.spent, self.conv, self.leaves = depth, n, spent, conv, leaf
        self.children, self.ends, self.waiting = 0, ends, []
        self.first, self.last, self.sums = first, last, sums


def forest(rows: list[tuple], left: int, right: int) -> Iterator[tuple]:
    """The nodes of one sorted range of distinct sequences (key, words, n, conv, ends).

    ``left`` and ``right`` are the LCP with the neighbouring ranges, -1 without one. Yields
    (conv, depth, parent_conv, n, children, leaves, saved, ends, id, parent_id, spent, before);
    nodes that other ranges share have an id and sums of their own, all others are final, but
    for the ``parent_conv`` of those whose parent is shared, which have a parent_id.
    """
    m, out = len(rows), []
    keys = [r[0] for r in rows]
    left_ids = _prefix_ids(keys[0], max(left, 0)) if left >= 0 else []
    right_ids = _prefix_ids(keys[-1], max(right, 0)) if right >= 0 else []
    parts: list = []
    for i, (key, words, n, conv, ends) in enumerate(rows):
        sums = [0, *accumulate(words)]
        depth = len(words)
        leaf = 0 if i == m - 1 and right >= depth else 1
        parts.append(_Part(depth, n, (n - 1) * sums[-1], conv, leaf, ends, i == 0, i == m - 1, sums))
    shared = [0, *(shared_units(a, b) for a, b in zip(keys, keys[1:], strict=False))]
    root = list(range(m))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def id_of(part, d):
        if part.first and d <= left:
            return left_ids[d]
        return right_ids[d] if part.last and d <= right else None

    def close(part, top):
        """Write the chain of a finished component above depth ``top``; its first row's place."""
        below = part.waiting
        for d in range(part.bottom, top, -1):
            ident = id_of(part, d)
            for k in below:
                out[k][2 if ident is None else 9] = part.conv if ident is None else ident
            at_bottom = d == part.bottom
            children = part.children if at_bottom else 1
            spent = part.spent
            if part.first and d <= left:  # what unites this range with the one before it
                spent += part.sums[left]
                children -= d < left
            before = part.sums[max(d - 1, 0)]
            out.append(
                [part.conv, d, None, part.n, children, part.leaves, spent - (part.n - 1) * before,
                 part.ends if at_bottom else None, ident, None, spent, before]
            )
            below = [len(out) - 1]
        return below[0]

    def opened(part, depth):
        """The component as part of a node at ``depth``."""
        if part.bottom > depth:
            part.waiting = [close(part, depth)]
            part.bottom, part.children, part.ends = depth, 1, None
        elif not part.children:
            part.leaves = 0  # it ends here, and what it is united with goes on
        return part

    for i in sorted(range(1, m), key=lambda i: -shared[i]):
        depth = shared[i]
        a, b = find(i - 1), find(i)
        one, two = opened(parts[a], depth), opened(parts[b], depth)
        if len(one.waiting) < len(two.waiting):
            one.waiting, two.waiting = two.waiting, one.waiting
        one.waiting += two.waiting
        one.n += two.n
        one.spent += two.spent + two.sums[depth]
        one.conv = min(one.conv, two.conv)
        one.leaves += two.leaves
        one.children += two.children
        one.ends = one.ends or two.ends
        one.first, one.last = one.first or two.first, one.last or two.last
        root[b], parts[b] = a, None
    close(parts[find(0)], -1)
    return out


_NODES = pa.schema(
    [
        *((x, pa.int64()) for x in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children")),
        *((x, pa.int64()) for x in ("n_leaves", "saved_tokens")),
        ("ends_sha256", pa.string()), ("id", pa.binary()), ("parent_id", pa.binary()),
        ("spent", pa.int64()), ("before", pa.int64()),
    ]
)
_NODES_DDL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, id binary, parent_id binary, spent long, before long"
)


def _ranges(distinct: DataFrame) -> DataFrame:
    """The distinct sequences in key order, in ranges of a bounded size, with their number."""
    stored = materialize(distinct, "distinct-conversations")
    total = stored.agg(F.sum(F.octet_length("key"))).first()[0] or 0
    spread = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored.repartitionByRange(max(spread, total // TASK_BYTES + 1), "key")
    return checkpointed(ranged.sortWithinPartitions("key").withColumn("part", F.spark_partition_id()))


def _borders(ranges: DataFrame) -> dict[int, tuple[int, int]]:
    """For each range, the LCP with the range before it and with the one after it."""
    schema = pa.schema([("part", pa.int32()), ("first", pa.binary()), ("last", pa.binary())])

    def run(batches):
        part = first = last = None
        for batch in batches:
            if batch.num_rows:
                keys = batch.column("key")
                first = keys[0].as_py() if part is None else first
                part, last = batch.column("part")[0].as_py(), keys[batch.num_rows - 1].as_py()
        if part is not None:
            yield pa.RecordBatch.from_pylist([{"part": part, "first": first, "last": last}], schema=schema)

    ends = ranges.select("part", "key").mapInArrow(run, "part int, first binary, last binary")
    found = sorted((r["part"], bytes(r["first"]), bytes(r["last"])) for r in ends.collect())
    if not found:
        return {}
    meet = [shared_units(a[2], b[1]) for a, b in zip(found, found[1:], strict=False)]
    return {
        part: (left, right)
        for (part, _, _), left, right in zip(found, [-1, *meet], [*meet, -1], strict=True)
    }


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """A row for each node of the trie of ``conv_id, turns`` (see ``sequences``)."""
    ranges = _ranges(_distinct(seqs))
    borders = _borders(ranges)

    def run(batches):
        part, rows = None, []
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                names = ("key", "words", "n", "conv", "ends")
                rows += zip(*(batch.column(x).to_pylist() for x in names), strict=True)
        if rows:
            nodes = forest(rows, *borders[part])
            for i in range(0, len(nodes), 10_000):
                columns = zip(*nodes[i : i + 10_000], strict=True)
                arrays = [pa.array(x, f.type) for x, f in zip(columns, _NODES, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_NODES)

    nodes = materialize(ranges.mapInArrow(run, _NODES_DDL), "trie-nodes")
    shared = nodes.where(c("id").isNotNull()).groupBy("id").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.max("ends_sha256").alias("ends_sha256"),
        F.max("parent_id").alias("parent_id"), F.sum("spent").alias("spent"),
        F.max("before").alias("before"),
    )
    names = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "ends_sha256", "parent_id"]
    saved = (c("spent") - (c("n_convs") - 1) * c("before")).alias("saved_tokens")
    merged = materialize(
        shared.select("id", *names, F.lit(None).cast("long").alias("parent_conv_id"), saved), "trie-borders"
    )
    rows = nodes.where(c("id").isNull()).drop("id", "spent", "before").unionByName(merged.drop("id"))
    parents = merged.select(c("id").alias("parent_id"), c("conv_id").alias("above"))
    if parents.count() <= BROADCAST_NODES:
        parents = F.broadcast(parents)
    return rows.join(parents, "parent_id", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def oracle_sql() -> str:
    """Every prefix of every rebuilt conversation; subtree sums over the paths of all nodes."""
    return rf"""
WITH t AS (SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
      FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, k, w, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, substr(k, 1, {2 * UNIT})) AS i FROM t),
c AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base,
        {crc32_sql('CAST(conv_id AS VARCHAR)')} % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, o.i, k, w FROM c JOIN o ON o.conv_id = base AND o.i <= h
      UNION ALL SELECT c.conv_id, 1, o.i, k, w FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > h),
d AS (SELECT conv_id, w, row_number() OVER x AS d, sha256(string_agg(k, '') OVER x) AS p FROM r
      WINDOW x AS (PARTITION BY conv_id ORDER BY part, i)
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
s AS (SELECT *, lag(p) OVER x AS up, d = max(d) OVER (PARTITION BY conv_id) AS ends FROM d
      WINDOW x AS (PARTITION BY conv_id ORDER BY d)),
n AS (SELECT p, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS e
      FROM s GROUP BY p, d),
k AS (SELECT up AS p, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
a AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (p, d)),
u AS (SELECT s.p, s.d, count(*) FILTER (a.n_children = 0) AS n_leaves, sum((a.n - 1) * a.w) AS saved
      FROM a JOIN s ON s.conv_id = a.conv_id AND s.d <= a.d GROUP BY ALL)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, b.conv_id AS parent_conv_id, CAST(a.n AS BIGINT) AS n_convs,
  CAST(a.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, a.e AS ends_sha256
FROM a JOIN u ON u.p = a.p AND u.d = a.d LEFT JOIN a b ON b.p = a.up AND b.d = a.d - 1
"""
