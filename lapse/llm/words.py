"""Vectorised words, word hashes and window hashes of a batch of texts.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; these separators are ASCII,
so the rule holds on UTF-8 bytes as it does on code points.  Everything here is a small
numpy helper called on one Arrow batch inside a Spark task: whole texts, no row loops.

Hashes are polynomial (Rabin-Karp) modulo 2^64 with an odd base: a prefix sum of
``value * base^position``, then for any range ``(sum[end] - sum[start]) * base^-start``,
followed by a 64-bit finaliser.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
BASE_BYTES = 0x9E3779B97F4A7C13
BASE_WORDS = 0xD1342543DE82EF9B
SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply), a bijection for each seed."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUE = mix64(np.arange(256, dtype=np.uint64), 7) | U(1)
_LOWER_VALUE = BYTE_VALUE[_LOWER]
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, grown by doubling and kept per process."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(10, (n - 1).bit_length())
        out = np.ones(size, np.uint64)
        k = 1
        while k < size:
            out[k : 2 * k] = out[:k] * U(pow(base, k, 1 << 64))
            k *= 2
        _POWERS[base] = have = out
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of each [start, end) over a prefix sum of value * base^position."""
    inv = powers(inverse(base), len(prefix))
    return (prefix[end] - prefix[start]) * inv[start]


def prefix_sum(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] values), start[1], ..."""
    total = np.cumsum(n)
    if not len(total) or not total[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(start - (total - n), n) + np.arange(total[-1])


@dataclass
class Words:
    """Words of a batch: byte range of each, and the first word of each document (n_docs + 1)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    lower: bool

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        value = (_LOWER_VALUE if self.lower else BYTE_VALUE)[self.data]
        h = range_hash(prefix_sum(value, BASE_BYTES), self.start, self.end, BASE_BYTES)
        return mix64(h ^ (self.end - self.start).astype(np.uint64))

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, 64-bit hash) of every window of k consecutive words of one document."""
        n = len(hashes)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        doc = self.doc
        at = np.flatnonzero(doc[: n - k + 1] == doc[k - 1 :])
        return at, mix64(range_hash(prefix_sum(hashes, BASE_WORDS), at, at + k, BASE_WORDS), k)


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of each text (null: none)."""
    arr = texts.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8))[off[0] : off[-1]]
    off = off - off[0]
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    begins, ends = word.copy(), word.copy()
    if len(data):
        begins[1:] &= ~word[:-1] | edge[1:-1]
        ends[:-1] &= ~word[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, off), lower)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the column holds about ``size`` bytes in each (one row at least)."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        n = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0)
        total = np.cumsum(n.to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, base + size, side="right")))
            yield batch.slice(at, to - at)
            at = to


def shingle_sets(texts: pa.Array, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text as 64-bit hashes, sorted by (text, hash).

    A text of fewer than k words (one at least) has its whole word sequence as the only
    shingle; without words the set is empty.  Returns (text index, hash, set size per text).
    """
    w = split_words(texts, lower)
    h = w.hashes()
    at, sh = w.windows(h, k)
    owner = w.doc[at] if len(at) else np.zeros(0, np.int64)
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    if len(short):
        whole = range_hash(prefix_sum(h, BASE_WORDS), w.first[short], w.first[short + 1], BASE_WORDS)
        owner = np.concatenate([owner, short])
        sh = np.concatenate([sh, mix64(whole ^ w.counts[short].astype(np.uint64), 1)])
    n = len(w.first) - 1
    if len(short):
        order = np.argsort(owner, kind="stable")
        owner, sh = owner[order], sh[order]
    edge = np.searchsorted(owner, np.arange(n + 1))
    for i in np.flatnonzero(np.diff(edge) > 1):
        sh[edge[i] : edge[i + 1]].sort()
    keep = np.ones(len(sh), bool)
    keep[1:] = (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])
    owner, sh = owner[keep], sh[keep]
    return owner, sh, np.bincount(owner, minlength=n)
