"""Vectorised work on the UTF-8 bytes of a batch of texts, for use inside tasks.

Hashes of byte ranges come from prefix sums: with powers of an odd base modulo 2^64, the sum over a
range, divided by the power at its start, depends on the bytes of the range alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes of words without punctuation: digits, letters and all beyond ASCII.
NAME_BYTES = np.zeros(256, dtype=bool)
NAME_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
STEPS = mix(np.arange(1001, 1065, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse, grown to the longest range seen."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = _powers(_BASE, size)
            self.down = _powers(pow(_BASE, -1, 1 << 64), size)
        return self.up[:n], self.down[:n]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _Powers()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offset of each text; a null text is empty."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    buffers = texts.buffers()
    at = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2] or b"", dtype=np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``limit`` text bytes; a longer text is a part of its own."""
    if batch.num_rows == 0:
        return
    _, at = flat(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(at, at[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums (one more than bytes) and the inverse powers to shift ranges with."""
    up, down = _POWERS.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * up[:-1], out=sums[1:])
    return sums, down


def range_hash(sums, down, start, stop) -> np.ndarray:
    """Hash of the bytes from ``start`` to ``stop``, for arrays of both."""
    return mix((sums[stop] - sums[start]) * down[start])


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return _LOWER[data]


def word_spans(
    data: np.ndarray, at: np.ndarray, inside: np.ndarray = ~_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and stop of the runs of bytes ``inside``, and the first run of each text."""
    word = inside[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[at] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = word[:-1]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | first[:-1]))
    stops = np.flatnonzero(word & (~after | first[1:])) + 1
    return starts, stops, np.searchsorted(starts, at)


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z as a-z, and the first word of each text."""
    data, at = flat(column)
    starts, stops, first = word_spans(data, at)
    sums, down = prefix_hash(_LOWER[data] if lower else data)
    return range_hash(sums, down, starts, stops), first


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on, as far as ``hashes`` goes."""
    out = np.zeros(max(0, len(hashes) - n + 1), dtype=np.uint64)
    for i in range(n):
        out += hashes[i : i + len(out)] * STEPS[i]
    return mix(out)


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the ``n``-word shingles of each text.

    A shorter text is one shingle of all its words; one without words has none.
    """
    words, first = word_hashes(column)
    grams = gram_hashes(words, n)
    for start, stop in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if stop - start >= n:
            yield np.unique(grams[start : stop - n + 1])
        elif stop > start:
            yield gram_hashes(words[start:stop], stop - start)
        else:
            yield np.zeros(0, dtype=np.uint64)
