"""Near-duplicates, repeated strings and decontamination against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest

from riskspark.llm import decontaminate, graph, near, repeats

DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, doc int"


def frame(spark, texts, first=0):
    rows = [(i, t, None, None, len(t or ""), "x", 1) for i, t in enumerate(texts, first)]
    return spark.createDataFrame(rows, DOCS)


def words(pick, n):
    return [f"{pick.choice('abcdefgh')}{pick.randrange(5000)}" for _ in range(n)]


def corpus():
    pick = random.Random(11)
    texts = [None, "", "  \n", "one", "one", "two words", "Two WORDS", "three little words"]
    for _ in range(12):
        base = words(pick, pick.randrange(60, 200))
        for _ in range(pick.randrange(1, 8)):
            copy = list(base)
            for _ in range(pick.randrange(0, 8)):
                copy[pick.randrange(len(copy))] = pick.choice("xyz") + str(pick.randrange(9999))
            texts.append(" ".join(copy))
    hot = words(pick, 120)
    for i in range(80):  # a group whose members differ from each other
        copy = list(hot)
        for _ in range(i % 7):
            copy[pick.randrange(len(copy))] = f"v{pick.randrange(9999)}"
        texts.append(" ".join(copy))
    shared = " ".join(words(pick, 30))
    texts += [" ".join(words(pick, 40)) + "\n" + shared + "\n" + " ".join(words(pick, 40)) for _ in range(9)]
    texts.append(" ".join(words(pick, 20_000)))
    texts += ["é" * 60 + " end", "xx " + "é" * 60, "ñ" * 30 + "é" * 24]
    pick.shuffle(texts)
    return texts


def shingles(text, n):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}


def expected_components(texts, n):
    sets = [shingles(t, n) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("rules", [near.NearRules(shingle=4), near.NearRules(shingle=2, rounds=0, block=16)])
def test_near_duplicates(spark, rules):
    texts = corpus()
    got = {r["doc_id"]: r for r in near.near_duplicates(frame(spark, texts), rules).collect()}
    for i, (size, component) in enumerate(expected_components(texts, rules.shingle)):
        row = got[i]
        assert (row["n_shingles"], row["component_id"]) == (size, component)
        assert row["kept"] == (component == i)


def test_one_of_each_group_stays(spark):
    texts = ["a b c d e f g h", "A b c d e f g h", "other words here that are not alike at all", None]
    docs = frame(spark, texts)
    docs = docs.unionByName(docs).unionByName(
        spark.createDataFrame([(None, "a b c d e f g h", None, None, 1, "x", 1)], DOCS)
    )
    clean = near.clean_documents(docs)
    assert clean.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == ["0", "2", "3", "None"]
    assert near.clean_documents(docs.limit(0)).count() == 0


def test_pairs_dropped_at_the_chosen_probability():
    rules = near.NearRules()
    bounds = near.least_matches(rules)
    assert bounds[-1][0] == rules.size
    assert all(m < 0.8 * n for n, m in bounds)
    assert [m / n for n, m in bounds] == sorted(m / n for n, m in bounds)


def test_components_of_long_paths(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 103), (103, 101), (7, 7)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def expected_repeats(texts, length=50):
    seen, out = {}, []
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        starts = [raw[p : p + length] for p in range(len(raw) - length + 1)]
        covered = bytearray(len(raw))
        for p, s in enumerate(starts):
            if s in seen:
                covered[p : p + length] = b"\1" * length
        for s in starts:
            seen.setdefault(s, i)
        kept = bytes(b for b, c in zip(raw, covered, strict=True) if not c)
        spans = sum(c and not (p and covered[p - 1]) for p, c in enumerate(covered))
        out.append((len(raw), sum(covered), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def repeat_corpus():
    pick = random.Random(2)
    texts = corpus()
    for n in (49, 50, 51, 60, 200):  # passages of exact lengths between other text
        passage = "".join(pick.choice("ab ") for _ in range(n))
        for _ in range(4):
            texts.append("".join(pick.choice("cdef ") for _ in range(pick.randrange(0, 90))) + passage + "".join(pick.choice("ghi ") for _ in range(pick.randrange(0, 90))))
    texts += ["a" * 500, "a" * 49, "a" * 50, "ab" * 300, "b" + "ab" * 40, "z" * 3000 + "a" * 70]
    line = "this line comes again and again in one and the same document"
    texts += ["\n".join([line] * 30), line + "!", "x" + line]
    return texts


@pytest.mark.parametrize("rules", [repeats.RepeatRules(), repeats.RepeatRules(seed=8), repeats.RepeatRules(length=20, seed=20)])
def test_repeats(spark, rules):
    texts = repeat_corpus()
    got = {r["doc_id"]: r for r in repeats.repeats(frame(spark, texts).repartition(7), rules).collect()}
    for i, (size, removed, spans, digest, _) in enumerate(expected_repeats(texts, rules.length)):
        row = got[i]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]) == (size, removed, spans, digest)


def test_repeats_stage(spark):
    texts = repeat_corpus()
    docs = frame(spark, texts)
    nobody = spark.createDataFrame([(None, texts[8], None, None, 5, "x", 1)], DOCS)
    both = docs.unionByName(docs).unionByName(nobody)
    clean = repeats.without_repeats(both)
    assert clean.columns == docs.columns
    rows = defaultdict(list)
    for r in clean.collect():
        rows[r["doc_id"]].append(r)
    for i, (_, removed, _, _, kept) in enumerate(expected_repeats(texts)):
        for r in rows[i]:
            if removed:
                assert r["text"] == kept.decode(errors="ignore") and r["n_chars"] == len(r["text"])
            else:
                assert r["text"] == texts[i]
        assert len(rows[i]) == 2
    assert rows[None][0]["text"] == texts[8]
    assert repeats.without_repeats(docs.limit(0)).count() == 0


def leaked_corpus():
    pick = random.Random(4)
    items = [" ".join(words(pick, n)) for n in (40, 30, 20, 13, 9, 5, 3)] + [None, "", "..."]
    texts = [None, "", "nothing", " ".join(words(pick, 5000))]
    planted = set()
    for j, item in enumerate(items[:7]):
        own = item.split()
        for changes in (0, 1, 2):
            copy = [w.upper() + "," for w in own]
            if changes and len(own) < 20:
                continue
            for k in range(changes):  # substitutions far apart
                copy[(k + 1) * len(own) // (changes + 1)] = "changed"
            texts.append(" ".join(words(pick, 30) + copy + words(pick, 30)))
            planted.add((len(texts) - 1, j))
    clean = [" ".join(words(pick, 20) + items[0].split()[:9] + words(pick, 20)) for _ in range(5)]
    return items, texts + clean, planted


def test_decontamination(spark):
    items, texts, planted = leaked_corpus()
    benchmark = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(items)] + [(None, items[0], "x"), (0, items[0], "y")],
        "item_id long, text string, doc_id string",
    )
    docs = frame(spark, texts)
    for rules in (decontaminate.LeakRules(), decontaminate.LeakRules(block_words=25)):
        got = decontaminate.overlaps(docs.unionByName(docs), benchmark, rules).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == planted
        assert len(got) == len(planted)
    clean = decontaminate.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in planted}
    assert decontaminate.overlaps(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.clean_documents(docs.limit(0), benchmark).count() == 0


def test_masks_ignore_substitutions():
    own = [f"w{i}" for i in range(15)]
    import pyarrow as pa

    base, _ = decontaminate.name_hashes(pa.array([" ".join(own)]))
    changed = list(own)
    changed[7] = "other"
    new, _ = decontaminate.name_hashes(pa.array([" ".join(changed)]))
    table = decontaminate.SeedTable([(1, base)], decontaminate.LeakRules())
    assert sum(len(at) for at, _, _ in table.hits(new))
    assert decontaminate.best_stretch(base == new, 2) == (0, 15)
