"""Spelling variants, the prefix trie and sharding against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskspark.llm import prefix_trie, sharding, spelling

DOCS = "doc_id long, text string, word string, shard string, slot int, n int, size int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in rows], DOCS)


# --- spelling -------------------------------------------------------------------------------


def expected_variants(rows, letters=5, occurrences=3, dropping=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if dropping and h % dropping == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= letters and n >= occurrences}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = defaultdict(list)
    for a in words:
        for b in words:
            if a != b and abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].append(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def spelled(spark, rows, most=spelling.BLOCK, **rules):
    found = spelling.variants(docs_of(spark, rows), spelling.SpellingRules(**rules), most).collect()
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found]


def words_corpus():
    pick = random.Random(3)
    base = ["aaaaa", "aaaaaa", "aaaaab", "banana", "bananas", "straße", "Über", "ÜBERALL", "thinking", "x" * 300]
    base += ["".join(pick.choice("abé") for _ in range(pick.randrange(5, 9))) for _ in range(60)]
    rows = [(None, "hello wörld hellos hellos hellos"), (1, None), (2, ""), (3, " 12 ×÷ -- "), (4, "hello")]
    for d in range(40):
        text = []
        for _ in range(60):
            w = pick.choice(base[: 1 + pick.randrange(len(base))])
            if pick.random() < 0.3:
                k = pick.randrange(len(w))
                w = w[:k] + pick.choice(["", "a", "b", w[k] * 2]) + w[k + 1 :]
            text.append(w)
        rows.append((d % 30, " ".join(text)))
    return rows + rows[:5]  # ids and whole rows come again


@pytest.mark.parametrize("most", [spelling.BLOCK, 100])
def test_variants_equal_brute_force(spark, most):
    rows = words_corpus()
    got = spelled(spark, rows, most)
    assert len(got) == len(set(got))
    assert set(got) == expected_variants(rows)


def test_blocks_are_halved_and_lose_no_pair(spark):
    words = [a + b + "cde" for a in "abcdefghij" for b in "abcdefghij"] + ["acde", "xbcde", "abcdde"]
    table = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    parts = spelling.blocks(table, 12)
    assert len(parts) > 1
    sizes = [r["count"] for p in parts for r in p.groupBy("block", "lo", "hi").count().collect() if r.hi - r.lo > 1]
    assert max(sizes) <= 12
    few = {r.word: (r.n_near, r.best) for r in spelling.neighbours(table, 12).collect()}
    assert few == {r.word: (r.n_near, r.best) for r in spelling.neighbours(table).collect()}
    assert few["abcde"][0] == 9 + 9 + 3


def test_long_text_is_read_in_pieces(monkeypatch):
    text = " ".join(["Hello", "wörld", "ÄÖ", "x" * 40] * 30)
    whole = spelling.runs_of(text)
    monkeypatch.setattr(spelling, "_PIECE", 7)
    assert spelling.runs_of(text) == whole and whole["hello"] == 30


def test_variants_of_no_rows(spark):
    assert spelled(spark, []) == []


# --- prefix trie ----------------------------------------------------------------------------


def expected_trie(rows, heads=True):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            by_conv[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in by_conv.items()}
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4 if heads else 0
        built[conv] = own.get(conv - conv % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = Counter(node[:-1] for node in members if node)
    own_saved = {n: (len(m) - 1) * len((n[-1][1] if n else "").split()) for n, m in members.items()}
    leaves, saved = Counter(), Counter()
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += own_saved[node]
    out = Counter()
    for node, convs in members.items():
        ends = ",".join(str(x) for x in sorted(x for x in convs if len(built[x]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out[(min(convs), len(node), parent, len(convs), children[node], leaves[node], saved[node], digest)] += 1
    return out


def trie(spark, rows, heads=True):
    table = spark.createDataFrame(
        [(*r, 5, "z") for r in rows], "conv_id long, turn long, role string, text string, n long, key string"
    )
    seqs = prefix_trie.sequences(table)
    found = prefix_trie.prefix_trie(prefix_trie.with_family_heads(seqs) if heads else seqs).collect()
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return Counter(tuple(r[x] for x in names) for r in found)


def talk(seed=1, n=150):
    pick = random.Random(seed)
    rows = [(None, 0, "user", "lost"), (7000, None, None, None), (7000, 3, "user", "b"), (7000, 3, "user", "a")]
    rows += [(7001, 1, "user", "hi there")] * 2
    for conv in range(n):
        for turn in range(pick.randrange(1, 7)):
            role = "user" if turn % 2 == 0 else "assistant"
            rows.append((conv, turn, role, " ".join(pick.choice("ab") for _ in range(pick.randrange(0, 3)))))
    for conv in range(500, 560):  # exact copies, some of them longer
        rows += [(conv, t, "user", f"same words {t}") for t in range(4 if conv % 3 else 9)]
    rows += [(900, t, "user", f"long {t % 5}") for t in range(150)]
    return rows


@pytest.mark.parametrize("heads", [True, False])
def test_trie_equals_brute_force(spark, heads):
    rows = talk()
    random.Random(2).shuffle(rows)
    assert trie(spark, rows, heads) == expected_trie(rows, heads)


def test_forests_of_any_cuts_merge(spark, monkeypatch):
    rows = [(c, t, "user", f"t{t}" if t < 5 else f"own {c % 9} {t}") for c in range(90) for t in range(3 + c % 7)]
    for size in (200, 1 << 20):
        monkeypatch.setattr(prefix_trie, "TASK_BYTES", size)
        assert trie(spark, rows, heads=False) == expected_trie(rows, heads=False)


def test_trie_of_few_rows(spark):
    assert not trie(spark, [])
    assert trie(spark, [(5, 0, "user", "one two")], heads=False) == expected_trie(
        [(5, 0, "user", "one two")], heads=False
    )
    rows = [(21, 0, "user", "gone")]  # its family's first is absent
    assert trie(spark, rows) == expected_trie(rows)


# --- sharding -------------------------------------------------------------------------------


def place_of(key, weights):
    import math

    bids = []
    for i, w in enumerate(weights):
        u = (int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16) + 1) / 16**13
        bids.append((math.log(u) / w, -i))
    return -max(bids)[1]


def test_numbers_equal_brute_force(spark):
    rows = [(i, "text é" * (i % 7)) for i in range(400)] + [(None, None), (None, "x"), (3, "other"), (5, None)]
    rows += [(77, "hot")] * 200
    got = sharding.number(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        key = "" if r.doc_id is None else r.doc_id
        assert r.shard == place_of(key, [1.0] * 40) and r.grown_shard == place_of(key, [1.0] * 41)
        assert r.grown_shard in (r.shard, 40) and r.law == "key"
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size))
    for found in slots.values():
        found.sort()
        assert [x[0] for x in found] == list(range(len(found)))
        assert [x[1:] for x in found] == sorted(x[1:] for x in found)
    sizes = Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    raw = [(d, (t or "").encode()) for d, t in rows]
    assert sizes == Counter((d, len(t) + 16, zlib.crc32(t)) for d, t in raw)


def test_weights_are_kept_and_few_rows_move(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    weights = (1.0, 2.0, 5.0)
    layout = sharding.Shards(weights, (4.0,))
    placed = ids.select(sharding.placement(F.col("doc_id"), layout).alias("p")).select("p.*")
    counts = {(r.shard, r.grown_shard): r["count"] for r in placed.groupBy("shard", "grown_shard").count().collect()}
    assert all(new in (old, 3) for old, new in counts)
    for i, w in enumerate(weights):
        share = sum(n for (old, _), n in counts.items() if old == i) / 20_000
        assert abs(share - w / 8) < 0.015
    moved = sum(n for (_, new), n in counts.items() if new == 3) / 20_000
    assert abs(moved - 4 / 12) < 0.015


def test_written_shards_hold_whole_rows(spark, tmp_path):
    rows = [(i % 50, f"t{i}") for i in range(500)] + [(None, None)]
    docs = docs_of(spark, rows)
    sharding.write_shards(docs, str(tmp_path / "out"), shards=sharding.Shards((1.0,) * 7), rows_per_file=40)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(rows)
    assert all(r.shard == place_of("" if r.doc_id is None else r.doc_id, [1.0] * 7) for r in back.collect())
    told = sharding.manifest(sharding.number(docs)).collect()
    assert sum(r.n_rows for r in told) == 501
    assert sum(r.n_bytes for r in told) == sum(len((t or "").encode()) + 16 for _, t in rows)


def test_sharding_of_no_rows_and_bad_weights(spark):
    assert sharding.number(docs_of(spark, [])).collect() == []
    with pytest.raises(ValueError):
        sharding.Shards((1.0, 0.0))
