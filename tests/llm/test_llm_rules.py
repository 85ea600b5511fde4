"""Licence scan, quality rules, chat formatting and token counts against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from riskspark.llm import chat, licenses, quality, token_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))


def frame(spark, texts, sources=None):
    rows = [
        (i, t, None, (sources or {}).get(i, "a"), len(t or ""), "x") for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


EDGES = [None, "", " \n\t", "one", "\n\n", LONG, "same same same", "same same same", "é ñ 😀"]


def test_quality_counts(spark):
    line = "the quick brown fox jumps over the lazy dog again"
    texts = [*EDGES, f"{line}\n{line}\n\n{line} # $", "a b c d e a b c d e f g", "x " * 40]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r for r in quality.quality(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        covered = {
            p
            for k in range(len(words) - 4)
            if windows[tuple(words[k : k + 5])] > 1
            for p in range(k, k + 5)
        }
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        row = got[i]
        assert row["n_words"] == len(words)
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == sum((text or "").count(c) for c in "#*$%&|<>")
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len(covered)
        assert row["base_failed"] == (len(words) < 10 or 100 * len(covered) > 20 * len(words))


def test_frequent_lines(spark):
    own = [" ".join(f"d{i}w{k}" for k in range(12)) for i in range(40)]
    texts = [f"Subscribe to our NEWSLETTER today  \n{own[i]}" for i in range(30)]
    texts += ["subscribe to our newsletter today\n" + own[30]]  # another host
    texts += ["subscribe to our newsletter today " * 2] * 3
    texts += [f"subscribe to our newsletter today\n{'subscribe to our newsletter today' }\nx"]
    hosts = {30: "b"}
    rules = quality.QualityRules(max_line_docs=20)
    docs = frame(spark, texts, hosts)
    got = {r["doc_id"]: r for r in quality.quality(docs, rules).collect()}
    assert all(got[i]["n_lines_removed"] == 1 and got[i]["kept"] for i in range(30))
    assert got[30]["n_lines_removed"] == 0
    assert got[34]["n_lines_removed"] == 2 and got[34]["depleted"] and not got[34]["kept"]
    clean = {r["doc_id"]: r for r in quality.clean_documents(docs, rules).collect()}
    assert clean[3]["text"] == own[3] and clean[3]["n_chars"] == len(own[3])
    assert clean[30]["text"] == texts[30]
    assert 34 not in clean
    assert quality.clean_documents(docs, rules).columns == docs.columns
    nobody = spark.createDataFrame([(None, own[2], None, None, 9, "x")], DOCS)
    twice = quality.clean_documents(docs.unionByName(docs).unionByName(nobody), rules)
    assert twice.count() == 2 * len(clean) + 1
    judged = quality.quality(docs.unionByName(docs), rules).collect()
    assert len(judged) == 2 * len(texts)
    assert all(r["n_lines_removed"] == got[r["doc_id"]]["n_lines_removed"] for r in judged)


@pytest.mark.parametrize("others", [0, 1500])
def test_a_banner_goes_from_hosts_of_every_size(spark, others):
    """25 different texts with one banner; the host's other texts don't matter."""
    pick = random.Random(4)

    def prose(i, n):
        return " ".join(f"{pick.choice('abcdefgh')}{pick.randrange(9000)}" for _ in range(n)) + f" {i}"

    texts = [f"accept all cookies here\n{prose(i, 40)}" for i in range(25)]
    texts += [f"only a few texts have this line\n{prose(i, 40)}" for i in range(20)]
    texts += [prose(i, 12) for i in range(others)]
    rows = {r["doc_id"]: r for r in quality.quality(frame(spark, texts)).collect()}
    assert [rows[i]["n_lines_removed"] for i in range(45)] == [1] * 25 + [0] * 20
    assert all(rows[i]["kept"] for i in range(45))


def test_near_copies_do_not_make_their_lines_frequent(spark):
    """A group of 120 near copies keeps its lines, a banner they share with others goes."""
    pick = random.Random(9)
    lines = [[f"{pick.choice('abcdefgh')}{pick.randrange(9000)}" for _ in range(12)] for _ in range(12)]
    texts = []
    for _ in range(120):
        copy = [list(line) for line in lines]
        for _ in range(pick.randrange(1, 4)):
            copy[pick.randrange(12)][pick.randrange(12)] = f"z{pick.randrange(9999)}"
        texts.append("subscribe to our letter\n" + "\n".join(" ".join(line) for line in copy))
    for _ in range(30):
        own = " ".join(f"{pick.choice('abcdefgh')}{pick.randrange(9000)}" for _ in range(50))
        texts.append("subscribe to our letter\n" + own)
    docs = frame(spark, texts)
    rows = quality.quality(docs).collect()
    assert [r["n_lines_removed"] for r in sorted(rows, key=lambda r: r["doc_id"])] == [1] * 150
    clean = {r["doc_id"]: r["text"] for r in quality.clean_documents(docs).collect()}
    assert clean == {i: t.split("\n", 1)[1] for i, t in enumerate(texts)}


def test_copies_do_not_make_a_line_frequent(spark):
    text = "\n".join(" ".join(f"l{k}w{j}" for j in range(8)) for k in range(5))
    docs = frame(spark, [text] * 60)
    assert quality.clean_documents(docs).count() == 60


def test_empty_tables(spark):
    empty = frame(spark, ["x"]).limit(0)
    assert quality.quality(empty).count() == 0
    assert quality.clean_documents(empty).count() == 0
    assert licenses.scan_documents(empty).count() == 0
    assert token_counts.token_counts(empty).count() == 0


def test_licence_scan(spark):
    filler = " ".join(f"q{i}" for i in range(100))
    texts = [
        *EDGES,
        "Released under the MIT License.",
        "MIT license. Under the  mit-License! under the mit license",
        f"{filler} Licensed under the Apache License, Version 2.0. {filler}",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC BY-NC 4.0.",
        "All rights are reserved",
        f"{filler} all {filler} rights {filler} reserved",
        "ALL RIGHTS\nRESERVED",
    ]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r for r in licenses.scan_documents(docs).collect()}
    scan = licenses.LicenceScan()
    for i, text in enumerate(texts):
        low = (text or "").translate(str.maketrans({c: c.lower() for c in map(chr, range(65, 91))}))
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [
            (label, p)
            for label, phrase in scan.phrases
            for p in range(len(words))
            if words[p : p + len(phrase.split())] == phrase.split()
        ]
        found, best = set(), 0.0
        for start in range(0, len(words), scan.step):
            block = set(words[start : start + scan.block])
            for (label, _), template in zip(scan.templates, scan.sizes, strict=True):
                common = len(block & set(template))
                if common >= scan.need(len(template)):
                    found.add(label)
                    best = max(best, common / len(template))
        row = got[i]
        assert row["n_words"] == len(words) and row["n_base"] == len(places)
        assert row["first_word"] == min((p for _, p in places), default=None)
        assert row["last_word"] == max((p for _, p in places), default=None)
        assert row["base_labels"] == ",".join(sorted({x for x, _ in places}))
        assert row["labels"] == ",".join(sorted(found | {x for x, _ in places}))
        assert row["score"] == (1.0 if places else pytest.approx(best))
    assert got[len(EDGES) + 3]["labels"] == "gpl"


def test_a_template_must_fit_the_blocks():
    with pytest.raises(ValueError):
        licenses.LicenceScan(block=16, step=8)


PARTS = ["<", "\\", "|", "s>", "/s>", "[", "INST]", "/INST]", "<SYS>>", "</SYS>>", "a", "\n",
         "<|end|>", "<|turn|>", " "]


def test_escapes_are_reversible():
    pick = random.Random(7)
    for _ in range(3000):
        text = "".join(pick.choice(PARTS) for _ in range(8))
        role = "".join(pick.choice(["\\", "n", "\n", "<", "|", "|>", "user"]) for _ in range(3))
        plain = chat.escape(text)
        assert chat.unescape(plain) == text
        assert "<|" not in plain and "</s>" not in plain and "[INST]" not in plain
        window, _ = chat.format_window([(role, text), ("x", "y")], 0)
        assert chat.read_window(window) == [(role, text), ("x", "y")]


def _conversations():
    pick = random.Random(3)
    rows = []
    for c in range(30):
        n = pick.randrange(1, 40)
        for t in range(n):
            role = "system" if t == 0 and c % 2 else pick.choice(["user", "assistant"])
            text = " ".join(pick.choice(["hi", "<|end|>", "[INST]", "x" * 9, "é"]) for _ in range(pick.randrange(0, 30)))
            rows.append((c, t, role, text, 1))
    rows += [(None, 0, "user", "no id", 1), (90, None, None, None, 1), (90, 1, "assistant", None, 1)]
    rows += [(91, 0, "assistant", "again", 1), (91, 0, "assistant", "again", 1)]
    rows += [(92, 0, "user", "word " * 5000, 1), (92, 1, "assistant", "word " * 5000, 1)]
    return rows


def test_chat_windows(spark):
    rows = _conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window int")
    rules = chat.ChatRules(budget=60, history=20)
    windows = chat.chat_windows(frame, rules)
    got = {r["conv_id"]: r for r in chat.read_back(windows).collect()}
    turns = defaultdict(list)
    for c, t, role, text, _ in rows:
        turns[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(turns)
    for c, own in turns.items():
        own.sort()
        every = "".join(f"{r}\n{x}\n" for _, r, x in own)
        under = "".join(x for _, r, x in own if r == "assistant")
        assert got[c]["n_turns"] == len(own)
        assert got[c]["turns_sha256"] == hashlib.sha256(every.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(under)
        assert got[c]["loss_sha256"] == hashlib.sha256(under.encode()).hexdigest()
    for w in windows.collect():
        assert w["n_tokens"] <= rules.budget or w["n_new"] == 1
        read = chat.read_window(w["text"])
        assert len(read) == w["n_context"] + w["n_new"]
        assert w["n_tokens"] == sum(chat.tokens_of(x) for _, x in read)
        own = sorted(turns[w["conv_id"]])
        if w["window"] > 0 and own[0][1] == "system":
            assert read[0] == own[0][1:] and w["n_context"] >= 1
            past = read[1 : w["n_context"]]
        else:
            past = read[: w["n_context"]]
        assert sum(chat.tokens_of(x) for _, x in past) <= rules.history
    assert max(r["n_windows"] for r in got.values()) > 3
    assert chat.read_back(chat.chat_windows(frame.limit(0))).count() == 0


@pytest.mark.parametrize("size", [10, 40, 90])
def test_a_long_system_turn_stays(size):
    rules = chat.ChatRules(budget=60, history=20)
    turns = [("system", "s " * size)] + [(r, f"{r} {i} " * 6) for i in range(9) for r in ("user", "assistant")]
    state = chat._fresh()
    windows = list(chat.windows_of(turns, rules, state))
    while (window := chat._next_window(state, rules, last=True)) is not None:
        windows.append(window)
    read = [chat.read_window(w["text"]) for w in windows]
    assert len(windows) > 3 and all(x[0] == turns[0] for x in read)
    assert [t for w, x in zip(windows, read, strict=True) for t in x[w["n_context"] :]] == turns
    assert all(w["n_tokens"] <= rules.budget or w["n_new"] == 1 for w in windows)


def _greedy(word, pieces):
    count, at, allowed = 0, 0, pieces.begin
    while at < len(word):
        end = len(word)
        while word[at:end] not in allowed:
            end -= 1
        at, count, allowed = end, count + 1, pieces.go_on
    return count


def test_longest_match_counts():
    single = {bytes([b]) for b in range(256)}
    pick = random.Random(5)
    for _ in range(200):
        some = lambda: {bytes(pick.choice(b"abc") for _ in range(pick.randrange(2, 6))) for _ in range(6)}
        pieces = token_counts.Pieces(frozenset(single | some()), frozenset(single | some()))
        automaton = token_counts.Automaton.build(pieces)
        for _ in range(50):
            word = bytes(pick.choice(b"abcd") for _ in range(pick.randrange(0, 20)))
            assert automaton.count(word) == _greedy(word, pieces), word


def test_token_counts_of_texts(spark):
    pieces = token_counts.read_pieces()
    docs = frame(spark, [*EDGES, "z" * 20_000 + " end"])
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs).collect()}
    texts = [*EDGES, "z" * 20_000 + " end"]
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        assert got[i]["n_words"] == len(words)
        if i < len(EDGES):
            assert got[i]["n_tokens"] == sum(_greedy(w, pieces) for w in words)
    assert got[len(EDGES)]["n_tokens"] > 1000
