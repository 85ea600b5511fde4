"""Token counts by a linear longest-match automaton.

Words (runs without ASCII white space) are cut greedily into the longest pieces of a vocabulary:
first a piece that may begin a word, then pieces that go on. Each trie node has a failure link, to
where matching goes on after the pieces that are certain by then, and the precomputed number of
those pieces. Counting takes time linear in the bytes of a word and builds no pieces.

The vocabulary is a byte-level rank file: pieces with a leading blank begin words, the others go on,
and each single byte may do both, so every word has a cut. The file is read on the driver, its
path is a parameter, and the automaton (of the file's size) is sent to the tasks.

Defined cases: a null or empty text has no words and no tokens; a word of any length is counted in
full; repeated rows are counted alike; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Words whose count a task remembers; when they are so many, it begins anew.
REMEMBERED = 200_000


@dataclass(frozen=True)
class Pieces:
    """Pieces that begin a word and pieces that go on."""

    begin: frozenset
    go_on: frozenset


def read_pieces(path: str = VOCABULARY) -> Pieces:
    with open(path, "rb") as lines:
        tokens = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    single = {bytes([b]) for b in range(256)}
    blank = set(b" \t\n\x0b\x0c\r")
    begin = {t[1:] for t in tokens if t[:1] == b" " and len(t) > 1 and not blank & set(t[1:])}
    go_on = {t for t in tokens if t and not blank & set(t)}
    return Pieces(frozenset(begin | single), frozenset(go_on | single))


@dataclass
class Automaton:
    """Edges by ``node * 256 + byte``, failure links and pieces popped on failure.

    Node 0 is the start of a word, node 1 the place after a piece.
    """

    edges: dict
    fail: list
    popped: list

    @classmethod
    def build(cls, pieces: Pieces) -> Automaton:
        edges: dict[int, int] = {}
        size = 2
        ends = set()
        for root, words in ((0, pieces.begin), (1, pieces.go_on)):
            for word in sorted(words):
                node = root
                for byte in word:
                    key = node * 256 + byte
                    node = edges.get(key, -1)
                    if node < 0:
                        node = edges[key] = size
                        size += 1
                ends.add(node)
        children: dict[int, list] = {}
        for key, child in edges.items():
            children.setdefault(key >> 8, []).append((key & 255, child))
        fail, popped = [-1] * size, [0] * size
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for byte, child in children.get(node, ()):
                queue.append(child)
                if child in ends:
                    fail[child], popped[child] = 1, 1
                    continue
                # Pop pieces of the parent until the byte can follow.
                at, count = fail[node], popped[node]
                while at >= 0 and at * 256 + byte not in edges:
                    count += popped[at]
                    at = fail[at]
                if at >= 0:
                    fail[child], popped[child] = edges[at * 256 + byte], count
        return cls(edges, fail, popped)

    def count(self, word: bytes) -> int:
        """Number of pieces of a word."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node, total = 0, 0
        for byte in word:
            following = edges.get(node * 256 + byte)
            while following is None:
                total += popped[node]
                node = fail[node]
                following = edges.get(node * 256 + byte)
            node = following
        while node > 1:
            total += popped[node]
            node = fail[node]
        return total


class _Counts(dict):
    """Counts of words seen before in the task."""

    def __init__(self, automaton: Automaton) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        count = self.automaton.count(word)
        if len(word) <= 64:
            self[word] = count
        return count


def token_counts(docs: DataFrame, pieces: Pieces | None = None) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_bytes`` of each row of ``docs``."""
    automaton = Automaton.build(pieces or read_pieces())
    shared = docs.sparkSession.sparkContext.broadcast(
        (automaton.edges, automaton.fail, automaton.popped)
    )

    def run(batches):
        counts = _Counts(Automaton(*shared.value))
        for batch in batches:
            words, tokens, sizes = [], [], []
            for text in batch.column("text"):
                raw = (text.as_py() or "").encode()
                cut = raw.split()
                words.append(len(cut))
                tokens.append(sum(map(counts.__getitem__, cut)))
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(x, pa.int64()) for x in (words, tokens, sizes)),
                ],
                names=["doc_id", "n_words", "n_tokens", "n_bytes"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_bytes long")
