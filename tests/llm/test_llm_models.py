"""Mixing, language-model scores, toxicity and the pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import lm_scores, mixing, toxicity

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, epoch string"


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, None, s, len(t or ""), "x") for i, t, s in rows], DOCS
    )


def mixed(spark):
    pick = random.Random(1)
    rows = []
    for i in range(600):
        source = "hot" if i % 3 == 0 else pick.choice(["b", "c", None])
        rows.append((i, " ".join(["w"] * pick.randrange(0, 60)), source))
    rows += [(600, None, "b"), (601, "", "only empty"), (None, "no id here", "b"), (5, "again", "b")]
    return rows, frame(spark, rows)


@pytest.mark.parametrize(
    "rules",
    [
        mixing.MixRules(entropy=0.997, block_tokens=300),
        mixing.MixRules(entropy=1.0, most_repeats=1.1, block_tokens=300),
        mixing.MixRules(entropy=1.0, most_repeats=50, budget_share=2.5, block_tokens=100_000),
        mixing.MixRules(entropy=0.1),
    ],
)
def test_mixture(spark, rules):
    rows, docs = mixed(spark)
    tokens = Counter()
    for _, text, source in rows:
        tokens[source] += len((text or "").split())
    tokens = {s: n for s, n in tokens.items() if n}
    total = sum(tokens.values())
    weights = mixing.source_weights(mixing.document_tokens(docs), rules).collect()
    x = weights[0]["exponent"]
    powers = {s: (n / total) ** x for s, n in tokens.items()}
    share = {s: p / sum(powers.values()) for s, p in powers.items()}
    assert {w["source"]: w["tokens"] for w in weights} == tokens
    for w in weights:
        assert w["weight"] == pytest.approx(share[w["source"]], abs=1e-9)
    entropy = -sum(p * math.log(p) for p in share.values()) / math.log(len(share))
    repeats = max(share[s] * total * rules.budget_share / tokens[s] for s in share)
    if rules.entropy == 0.997:
        assert entropy == pytest.approx(0.997, abs=1e-5)
    if rules.most_repeats == 1.1:
        assert repeats == pytest.approx(1.1, abs=1e-4)
    if rules.entropy == 0.1:
        assert x == 1.0

    drawn = mixing.mix(docs, rules).collect()
    by_source, by_epoch = Counter(), defaultdict(Counter)
    for r in drawn:
        by_source[r["source"]] += r["n_tokens"]
        by_epoch[r["source"], r["epoch"]][r["doc_id"], r["n_tokens"]] += 1
    present = Counter((i, len((t or "").split()), s) for i, t, s in rows if (t or "").split())
    for (source, epoch), own in by_epoch.items():
        full = next(w["full_epochs"] for w in weights if w["source"] == source)
        every = Counter({(i, n): c for (i, n, s), c in present.items() if s == source})
        assert own <= every
        if epoch < full:
            assert own == every
    for w in weights:
        assert w["quota"] - 60 < by_source[w["source"]] <= w["quota"]


def test_mixture_of_nothing(spark):
    _, docs = mixed(spark)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.where("source = 'only empty'")).count() == 0
    assert mixing.mix(docs, mixing.MixRules(budget_share=0.0)).count() == 0
    single = mixing.mix(docs.where("source = 'hot'"))
    assert single.count() == docs.where("source = 'hot' and text <> ''").count()


def _brute_scores(training, rules):
    chosen = training
    words = lambda t: (t or "").encode().lower().split()
    uni = [Counter(), Counter()]
    for r in chosen:
        uni[not r["target"]].update(words(r["text"]))
    every = uni[0] + uni[1]
    known = set()
    for n in sorted(set(every.values()), reverse=True):
        equal = {w for w, c in every.items() if c == n}
        if len(known) + len(equal) > rules.vocabulary:
            break
        known |= equal
    ids = lambda t: [w if w in known else b"" for w in words(t)]
    pairs = [Counter(), Counter()]
    for r in chosen:
        own = ids(r["text"])
        pairs[not r["target"]].update(zip(own, own[1:], strict=False))
    both = pairs[0] + pairs[1]
    size = len(known) + 1
    models = []
    for side in (0, 1):
        scale = min(1.0, uni[0].total() / max(1, uni[1].total())) if side else 1.0
        counts, before, mass = Counter(), Counter(), Counter()
        for w, c in uni[side].items():
            counts[w if w in known else b""] += scale * c
        for (a, b), c in pairs[side].items():
            before[a] += scale * c
            if both[a, b] >= rules.least:
                mass[a] += max(scale * c - rules.discount, 0)
        total = sum(counts.values())

        def p(a, b, side=side, scale=scale, counts=counts, before=before, mass=mass, total=total):
            low = (counts[b] + 1) / (total + size)
            if a is None:
                return low
            low *= max(1e-6, 1 - mass[a] / before[a]) if before[a] else 1.0
            if both[a, b] < rules.least:
                return low
            return max(scale * pairs[side][a, b] - rules.discount, 0) / max(before[a], 1) + low

        models.append(p)
    out = {}
    for r in training:
        own = ids(r["text"])
        gain = sum(
            math.log(models[0](a, b)) - math.log(models[1](a, b))
            for a, b in zip([None, *own[:-1]], own, strict=False)
        )
        out[r["doc_id"]] = (len(own), -gain / len(own) if own else 0.0)
    return out


@pytest.mark.parametrize("head", [50, 10_000])
def test_scores_equal_brute_force(spark, head):
    pick = random.Random(9)
    letters = lambda good: "abcd" if good else "cdef"
    rows = [
        (i, " ".join(pick.choice(letters(i % 2)) * pick.randrange(1, 4) for _ in range(pick.randrange(0, 90))), "s")
        for i in range(160)
    ] + [(200, None, None), (201, "ONE", None), (202, " ".join(["aa", "zz"] * 9000), "s")]
    docs = frame(spark, rows)
    labels = spark.createDataFrame(
        [(i, 1 if i % 2 else 0, 0) for i in range(0, 160, 3)] + [(7, None, None), (None, 1, 0), (9, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    rules = lm_scores.LmRules(vocabulary=8, least=2, head=head)
    got = {r["doc_id"]: r for r in lm_scores.scores(docs, labels, rules).collect()}
    expected = _brute_scores(lm_scores._training(docs, labels).collect(), rules)
    assert set(got) == set(expected)
    for i, (n, score) in expected.items():
        assert got[i]["n_words"] == n
        assert got[i]["score"] == pytest.approx(score, abs=1e-9)
    side = lambda k: [got[i]["score"] for i in range(160) if i % 2 == k and got[i]["n_words"] > 9]
    assert np.mean(side(1)) < np.mean(side(0))
    assert lm_scores.scores(docs.limit(0), labels).count() == 0
    nobody = lm_scores.scores(docs, labels.limit(0))
    assert all(r["score"] == 0.0 for r in nobody.collect())


def _whole_scores(training, rules):
    """Scores of models whose background counts are all counted, then scaled."""
    words = lambda t: (t or "").encode().lower().split()
    uni, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for r in training:
        own = words(r["text"])
        uni[not r["target"]].update(own)
        pairs[not r["target"]].update(zip(own, own[1:], strict=False))
    size, both = len(uni[0] + uni[1]) + 1, pairs[0] + pairs[1]
    scales = [1.0, min(1.0, uni[0].total() / uni[1].total())]

    def p(side, a, b):
        scale = scales[side]
        low = (scale * uni[side][b] + 1) / (scale * uni[side].total() + size)
        if a is None:
            return low
        own = [(x, scale * c) for x, c in pairs[side].items() if x[0] == a]
        total = sum(c for _, c in own)
        mass = sum(max(c - rules.discount, 0) for x, c in own if both[x] >= rules.least)
        low *= max(1e-6, 1 - mass / max(total, 1)) if total else 1.0
        if both[a, b] < rules.least:
            return low
        return max(scale * pairs[side][a, b] - rules.discount, 0) / max(total, 1) + low

    out = {}
    for r in training:
        own = words(r["text"])
        gain = sum(
            math.log(p(0, a, b)) - math.log(p(1, a, b))
            for a, b in zip([None, *own[:-1]], own, strict=False)
        )
        out[r["doc_id"]] = -gain / len(own) if own else 0.0
    return out


def test_every_document_counts(spark):
    pick = random.Random(4)
    rows = [
        (i, " ".join(pick.choice("abcd" if i < 8 else "cdefgh") for _ in range(30)), "s")
        for i in range(80)
    ] + [(90, None, "s")]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    rules = lm_scores.LmRules(head=5)
    training = lm_scores._training(docs, labels).collect()
    expected = _whole_scores(training, rules)
    got = {r["doc_id"]: r["score"] for r in lm_scores.scores(docs, labels, rules).collect()}
    assert got == pytest.approx(expected, abs=1e-9)
    nobody = lm_scores.scores(docs, labels.limit(0), rules).collect()
    assert all(r["score"] == 0.0 for r in nobody)


def test_vocabulary_is_filled_from_equally_frequent_words(spark):
    docs = frame(spark, [(0, "a a a b b b " + " ".join(f"tied{i}" for i in range(40)), "s")])
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    training = lm_scores._training(docs, labels)
    for cap, size in ((1, 1), (2, 2), (25, 25), (42, 42), (99, 42)):
        tables, _ = lm_scores.models(training, lm_scores.LmRules(vocabulary=cap))
        assert len(tables.vocabulary) == size
    assert lm_scores.LmRules().vocabulary >= 200_000


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def _sentences():
    pick = random.Random(6)
    words = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(900):
        toxic = i % 3 == 0
        own = [pick.choice(words) for _ in range(15)]
        if toxic:
            own[3] = pick.choice(["idiot", "moron"])
        # One group is named more often in toxic sentences.
        if pick.random() < (0.7 if toxic else 0.05):
            own[7] = "muslim"
        elif pick.random() < 0.3:
            own[7] = "christian"
        rows.append((i, " ".join(own), int(toxic)))
    return rows


def test_counterfactual_penalty():
    rows = _sentences()
    texts, labels = [t for _, t, _ in rows], [y for *_, y in rows]
    neutral = [f"word1 word2 {g} word3 word4" for g in ("muslim", "christian")]
    gaps, right = [], []
    for penalty in (0.0, 20.0):
        rules = toxicity.ToxicityRules(penalty=penalty)
        model = toxicity.train(texts, labels, rules)
        z = [model.weights[x].sum() for x in toxicity.features(pa.array(neutral), rules)]
        gaps.append(abs(z[0] - z[1]))
        z = np.array([model.weights[x].sum() + model.bias for x in toxicity.features(pa.array(texts), rules)])
        right.append(((z > 0) == np.array(labels)).mean())
    assert gaps[1] < 0.1 * gaps[0]
    assert right[1] > 0.99


def test_swap_terms():
    groups = toxicity.IDENTITY_GROUPS
    assert toxicity.swap_terms("A Muslim and women, womens menu", groups) == "A christian and men, womens menu"


def test_toxicity_edges(spark):
    rows = _sentences()
    docs = frame(spark, [(i, t, None) for i, t, _ in rows] + [(5000, None, None), (5001, "", "s"), (5001, "", "s"), (None, "idiot", None)])
    labels = spark.createDataFrame(
        [(i, y) for i, _, y in rows] + [(1, None), (None, 1), (99_999, 1)], "doc_id long, toxic int"
    )
    got = toxicity.toxicity(docs, labels)
    rows_out = got.collect()
    assert len(rows_out) == len(rows) + 4
    held = [r for r in rows_out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    truth = {i: y for i, _, y in rows}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.98
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    nothing = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {r["score"] for r in nothing} == {0.5}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names, rows = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, FOLDER)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
        rows[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    order = ["quality", "near_dedup", "suffix_dedup", "decontamination", "mixing"]
    assert list(rows) == order
    for before, after in zip(order, order[1:], strict=False):
        assert rows[after] <= rows[before]
    drawn = corpus_pipeline.run(spark, FOLDER).select("doc_id").distinct()
    assert {r["doc_id"] for r in drawn.collect()} == rows["mixing"]


def test_pipeline_keeps_one_of_many_near_copies(spark):
    def lines(name, n):
        return [" ".join(f"{name}l{k}w{j}" for j in range(12)) for k in range(n)]

    def variants(name, n):
        whole = lines(name, 10)
        return ["\n".join([*whole[: i % 10], f"{whole[i % 10]} edit{i}", *whole[i % 10 + 1 :]]) for i in range(n)]

    banner = "we use cookies on this site"
    texts = [(t, "a") for t in variants("few", 30)] + [(t, "b") for t in variants("third", 60)]
    texts += [("\n".join([banner, *lines(f"own{i}", 2)]), "b") for i in range(120)]
    docs = frame(spark, [(i, t, s) for i, (t, s) in enumerate(texts)])
    clean = corpus_pipeline.rule_quality(spark, docs, FOLDER)
    after = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert all(after[i] == texts[i][0] for i in range(90))
    assert all(after[i] == texts[i][0].removeprefix(banner + "\n") for i in range(90, 210))
    left = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, clean, FOLDER).collect()}
    assert left == {0, 30, *range(90, 210)}


def test_pipeline_line_limit_is_alike_in_large_hosts(spark):
    banner = "we use cookies on this site"
    own = [" ".join(f"d{i}w{j}" for j in range(14)) for i in range(3000)]
    texts = [f"{banner}\n{t}" if i < 25 else t for i, t in enumerate(own)]
    docs = frame(spark, [(i, t, "a") for i, t in enumerate(texts)])
    clean = corpus_pipeline.rule_quality(spark, docs, FOLDER).collect()
    assert {r["doc_id"]: r["text"] for r in clean} == dict(enumerate(own))


def test_pipeline_without_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
