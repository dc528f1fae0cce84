"""Operator 2: benchmark decontamination by SimHash windows and exact verification.

Words changed, put in or taken out break an item that is still at the similarity into few runs: each
place costs four shingles or more, so at least one run of ``shared_run`` words stays as it was.  An
item is looked for with windows of the largest size class w for which ``w + stride - 1`` words fit
into that run.  Every run of w words of the item is fingerprinted (64-bit SimHash of its 5-word shingles);
in a document the windows that start at multiples of the class's stride are, so the run holds an equal
window on either side.  Fingerprints are cut into ``RADIUS + 1`` blocks: two within the radius
agree on one block at least, so the block tables find all of them.  (Windows of an item's own length
would need a radius of 15 of 64 bits at a similarity of 0.8, in blocks of four bits, which select nothing.)

An exact path stands beside the fingerprints, for words in another order: a window that reaches the
similarity lacks at most ``n_shingles - least shared`` of the item's shingles, so it holds one of any larger
choice of them.  Each item is looked up by such a choice, its rarest shingles in the benchmark.  Every
item-sized window over a hit of either path is then verified on the exact shingles, weighted by their counts
(``sum of smaller counts / sum of larger counts``); the best one, the first of equals, is reported.  Items
of fewer than ``MIN_WORDS`` words are found as the very sequence of their words.

The benchmark is taken in chunks of at most ``CHUNK_WORDS`` words; each chunk's tables travel to the
tasks and every chunk sees every document, whole.  Documents are neither shuffled nor collected.

Defined cases: null and empty texts or items match nothing, so do items without words; letters are lower-cased; an empty benchmark
leaves every document; equal items are all reported; further columns are carried through.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.llm.names import quoted
from lapse.llm.words import Words, mix64, ranges, slices, split_words

SHINGLE = 5
PERCENT = 80
RADIUS = 3
BLOCK_BITS = 64 // (RADIUS + 1)
MIN_WORDS = 8
CHUNK_WORDS = 2_000_000
HEAD_BITS = 20
BATCH_BYTES = 1 << 20


def shared_run(n: int, percent: int = PERCENT) -> int:
    """Words of an item of n that the longest run left alone has in any window at the similarity: a window of
    k shingles lacks at most ``k - least shared`` of them, four or more at each place."""
    m = n - SHINGLE + 1
    runs = []
    for k in range(max(1, -(-percent * m // 100)), m + 1):
        shared = least_shared(m, k, percent)
        runs.append(-(-shared // ((k - shared) // (SHINGLE - 1) + 1)))
    return min(runs) + SHINGLE - 1


def size_class(n: int, percent: int = PERCENT) -> tuple[int, int]:
    """(window, stride) of an item of n words: classes 6, 8, 12, 16, 24, ... up to 128."""
    best, w, run = (6, 1), 6, shared_run(n, percent)
    while w <= 128 and w + w // 4 - 1 <= max(6, run):
        best = (w, max(1, w // 4))
        w = w * 4 // 3 if w.bit_count() == 2 else w * 3 // 2
    return best


def fingerprints(sums: list[np.ndarray], starts: np.ndarray, window: int) -> np.ndarray:
    """SimHash of the window's shingles at each start: counts of its power-of-two parts, added."""
    m, at = window - SHINGLE + 1, starts
    ones = np.zeros((len(starts), 64), np.uint8)
    for k, part in enumerate(sums):
        if m >> k & 1:
            ones += part[at]
            at = at + (1 << k)
    return np.packbits(ones > m // 2, axis=1).view(np.uint64)[:, 0]


def bit_sums(shingles: np.ndarray, window: int) -> list[np.ndarray]:
    """Counts of each of the 64 bits over 1, 2, 4, ... shingles from each on, for windows of up to ``window``
    words (at most 255 shingles)."""
    out = [np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1)]
    k = 1
    while 2 * k <= window - SHINGLE + 1:
        out.append(out[-1][:-k] + out[-1][k:])
        k *= 2
    return out


def all_shingles(hashes: np.ndarray, w) -> np.ndarray:
    """Shingle hash at every word; the last words of a document hold a filler that no window uses."""
    out = np.zeros(len(hashes), np.uint64)
    at, h = w.windows(hashes, SHINGLE)
    out[at] = h
    return out


@dataclass
class Class:
    """Fingerprints of one size class, by block value."""

    window: int
    stride: int
    prints: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    order: list[np.ndarray]
    edges: list[np.ndarray]


@dataclass
class Index:
    """Items, the fingerprints of their classes, and their shingles: ``keys`` are the sorted (item,
    shingle) keys with their counts in ``want``, ``seeds`` the sorted shingles that items are looked up
    by, ``seed_item`` their items; ``short`` has (words, sorted sequence hashes, their items) of the short items."""

    ids: list[int]
    size: np.ndarray
    classes: list[Class]
    keys: np.ndarray
    want: np.ndarray
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_head: np.ndarray
    short: list[tuple[int, np.ndarray, np.ndarray]]


def item_key(item: np.ndarray, shingle: np.ndarray) -> np.ndarray:
    return mix64(shingle ^ mix64(item.astype(np.uint64), 31), 32)


def head(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(64 - HEAD_BITS)).astype(np.int64)


def least_shared(a, b, percent: int):
    """Smallest number of shared shingles at which sets of a and b shingles reach the similarity."""
    return -(-percent * (a + b) // (100 + percent))


def lookup(item: np.ndarray, shingle: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, item) sorted by shingle: of each item its rarest shingles, as many as no window that
    reaches the similarity can lack."""
    if not len(item):
        return shingle, item
    values, at, often = np.unique(shingle, return_inverse=True, return_counts=True)
    order = np.lexsort((shingle, often[at], item))
    item, shingle = item[order], shingle[order]
    size = np.bincount(item)
    # the union holds the whole item, so percent of its shingles are shared by a shorter document too
    lacks = size - -(-percent * size // 100)
    place = np.arange(len(item)) - (np.cumsum(size) - size)[item]
    seed = place <= lacks[item]
    both = np.unique(np.stack([shingle[seed], item[seed].astype(np.uint64)]), axis=1)
    return both[0], both[1].astype(np.int64)


def build_index(items: list[tuple[int, str]], percent: int = PERCENT) -> Index:
    ids, sizes, grams, found, brief = [], [], [], {}, {}
    for item_id, text in items:
        w = split_words(pc.utf8_lower(pa.array([text], pa.string())))
        n = len(w.start)
        if not n:
            continue
        if n < MIN_WORDS:
            brief.setdefault(n, []).append((w.windows(w.hashes(), n)[1][0], len(ids)))
            ids.append(item_id)
            sizes.append(n)
            grams.append(np.zeros(0, np.uint64))
            continue
        shingles = all_shingles(w.hashes(), w)
        window, stride = size_class(n, percent)
        starts = np.arange(n - window + 1)
        prints = fingerprints(bit_sums(shingles, window), starts, window)
        found.setdefault((window, stride), []).append((prints, np.full(len(starts), len(ids)), starts))
        ids.append(item_id)
        sizes.append(n)
        grams.append(shingles[: n - SHINGLE + 1])
    classes = []
    for (window, stride), parts in sorted(found.items()):
        prints, item, offset = (np.concatenate(x) for x in zip(*parts))
        order, edges = [], []
        for j in range(RADIUS + 1):
            block = ((prints >> np.uint64(BLOCK_BITS * j)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            order.append(np.argsort(block, kind="stable"))
            edges.append(np.concatenate([[0], np.cumsum(np.bincount(block, minlength=1 << BLOCK_BITS))]))
        classes.append(Class(window, stride, prints, item, offset, order, edges))
    item = np.repeat(np.arange(len(ids)), [len(g) for g in grams])
    shingle = np.concatenate([np.zeros(0, np.uint64), *grams])
    keys, want = np.unique(item_key(item, shingle), return_counts=True)
    seeds, seed_item = lookup(item, shingle, percent)
    seed_head = np.zeros(1 << HEAD_BITS, bool)
    seed_head[head(seeds)] = True
    short = []
    for n, some in sorted(brief.items()):
        some.sort()
        short.append((n, np.array([h for h, _ in some], np.uint64), np.array([i for _, i in some], np.int64)))
    return Index(ids, np.array(sizes, np.int64), classes, keys, want, seeds, seed_item, seed_head, short)


def near_prints(c: Class, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (window, fingerprint of the class) within the radius."""
    windows, others = [], []
    for j in range(RADIUS + 1):
        block = ((prints >> np.uint64(BLOCK_BITS * j)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
        n = c.edges[j][block + 1] - c.edges[j][block]
        some = np.flatnonzero(n)
        if not len(some):
            continue
        n = n[some]
        begin = np.repeat(c.edges[j][block[some]] - (np.cumsum(n) - n), n)
        other = c.order[j][begin + np.arange(len(begin))]
        window = np.repeat(some, n)
        ok = np.bitwise_count(prints[window] ^ c.prints[other]) <= RADIUS
        windows.append(window[ok])
        others.append(other[ok])
    if not windows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(windows), np.concatenate(others)


def seed_hits(shingles: np.ndarray, real: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(position, item) of every shingle of the documents that an item is looked up by."""
    at = np.flatnonzero(real & index.seed_head[head(shingles)])
    lo, hi = (np.searchsorted(index.seeds, shingles[at], side) for side in ("left", "right"))
    return np.repeat(at, hi - lo), index.seed_item[ranges(lo, hi - lo)]


def short_hits(hashes: np.ndarray, w: Words, index: Index) -> list[tuple[int, int, int, float]]:
    """(row, item number, first word, 1.0): the first place of each short item in each text."""
    out = []
    for n, sequences, items in index.short:
        at, h = w.windows(hashes, n)
        lo, hi = (np.searchsorted(sequences, h, side) for side in ("left", "right"))
        row, item, at = np.repeat(w.doc[at], hi - lo), items[ranges(lo, hi - lo)], np.repeat(at, hi - lo)
        _, lead = np.unique(row * len(index.ids) + item, return_index=True)
        out += [(r, i, p, 1.0) for r, i, p in zip(row[lead].tolist(), item[lead].tolist(), (at - w.first[row])[lead].tolist())]
    return out


def best_window(keys: np.ndarray, want: np.ndarray, k: int, m: int, percent: int) -> tuple[int, int]:
    """(shared shingles, start) of the best window of k shingles over the item's key at each position
    (-1: not the item's), the first of equals; (0, 0) if none reaches the similarity with its m."""
    least = least_shared(m, k, percent)
    some = np.concatenate([[0], np.cumsum(keys >= 0)])
    starts = np.flatnonzero(some[k:] - some[:-k] >= least)
    if not len(starts):
        return 0, 0
    top, begin, last, shared = 0, 0, -1, 0
    have: Counter = Counter()
    row, wanted = keys.tolist(), want.tolist()
    for s in starts.tolist():
        if last < 0 or s - last >= k:
            have.clear()
            shared, gone, new = 0, (), row[s : s + k]
        else:
            gone, new = row[last:s], row[last + k : s + k]
        for x in gone:
            if x >= 0:
                shared -= have[x] <= wanted[x]
                have[x] -= 1
        for x in new:
            if x >= 0:
                have[x] += 1
                shared += have[x] <= wanted[x]
        last = s
        if shared > top:
            top, begin = shared, s
    return (top, begin) if top >= least else (0, 0)


def find(texts: pa.Array, index: Index, percent: int = PERCENT) -> list[tuple[int, int, int, float]]:
    """(row, item number, first word, similarity) of the best window per row and item that passes."""
    w = split_words(pc.utf8_lower(texts))
    if not len(w.start):
        return []
    hashes = w.hashes()
    exact = short_hits(hashes, w, index)
    if not len(index.keys):
        return exact
    shingles = all_shingles(hashes, w)
    sums = bit_sums(shingles, max(c.window for c in index.classes))
    doc, first = w.doc, w.first
    place = np.arange(len(doc)) - first[doc]
    left = first[doc + 1] - np.arange(len(doc))
    at, item = seed_hits(shingles, left >= SHINGLE, index)
    hits = [(at, item)]
    for c in index.classes:
        starts = np.flatnonzero((place & (c.stride - 1) == 0 if c.stride.bit_count() == 1 else place % c.stride == 0) & (left >= c.window))
        if not len(starts):
            continue
        window, other = near_prints(c, fingerprints(sums, starts, c.window))
        hits.append((starts[window], c.item[other]))
    at, item = (np.concatenate(x) for x in zip(*hits))
    if not len(at):
        return exact
    at, item = np.unique(np.stack([at, item]), axis=1)
    # the windows over the hits, as stretches of shingles; overlapping ones of a document and item are one
    order = np.lexsort((at, item, doc[at]))
    at, item = at[order], item[order]
    row, m = doc[at], index.size[item] - SHINGLE + 1
    grams = first[row + 1] - first[row] - SHINGLE + 1
    ok = 100 * np.minimum(grams, m) >= percent * m
    if not ok.any():
        return exact
    at, item, row, m, grams = at[ok], item[ok], row[ok], m[ok], grams[ok]
    lo, hi = np.maximum(at - m + 1, first[row]), np.minimum(at + m, first[row] + grams)
    new = np.ones(len(at), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (lo[1:] > hi[:-1])
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], len(at)) - 1
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for r, i, a, b, size, whole in zip(*(x.tolist() for x in (row[heads], item[heads], lo[heads], hi[ends], m[heads], grams[heads]))):
        part = item_key(np.full(b - a, i), shingles[a:b])
        where = np.minimum(np.searchsorted(index.keys, part), len(index.keys) - 1)
        keys = np.where(index.keys[where] == part, where, -1)
        # the item's keys by small numbers, so that only their counts are looked at
        mine, numbers = np.unique(keys, return_inverse=True)
        if mine[0] < 0:
            mine, numbers = mine[1:], numbers - 1
        k = min(size, whole)
        shared, start = best_window(numbers, index.want[mine], k, size, percent)
        value = shared / (size + k - shared)
        if shared and value > best.get((r, i), (0.0, 0))[0]:
            best[r, i] = (value, int(a - first[r]) + start)
    return exact + [(r, i, s, v) for (r, i), (v, s) in best.items()]


def indexes(benchmark: DataFrame, id_col: str, text_col: str, chunk_words: int, percent: int = PERCENT) -> Iterator[Index]:
    """The benchmark's index, in chunks of about ``chunk_words`` words."""
    items = benchmark.select(quoted(id_col).cast("long").alias("i"), quoted(text_col).cast("string").alias("t")).filter("t is not null")
    total = items.agg(F.sum(F.length("t") - F.length(F.translate("t", " \t\n\x0b\x0c\r", "")) + 1)).first()[0] or 0
    n = max(1, math.ceil(total / chunk_words))
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        index = build_index(sorted((r.i if r.i is not None else -1, r.t) for r in part.collect()), percent)
        if index.ids:
            yield index


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text", percent: int = PERCENT, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """(doc_id, item_id, first_word, similarity): one row per document row and item found in it."""
    schema = "doc_id long, item_id long, first_word long, similarity double"
    src = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    out = None
    for index in indexes(benchmark, item_id, item_text, chunk_words, percent):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, size=BATCH_BYTES):
                got = find(b.column("text"), index, percent)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array([g[0] for g in got], pa.int64())),
                     pa.array([index.ids[g[1]] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64()),
                     pa.array([g[3] for g in got], pa.float64())],
                    names=["doc_id", "item_id", "first_word", "similarity"],
                )

        part = src.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                        percent: int = PERCENT, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    out = docs
    for index in indexes(benchmark, item_id, item_text, chunk_words, percent):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, size=BATCH_BYTES):
                clean = np.ones(b.num_rows, bool)
                clean[[g[0] for g in find(b.column("text"), index, percent)]] = False
                yield b.select(["row"]).filter(pa.array(clean))

        row = F.struct(*[quoted(c) for c in docs.columns]).alias("row")
        kept = out.select(row, quoted(text_col).cast("string").alias("text")).mapInArrow(
            run, T.StructType([T.StructField("row", docs.schema)]))
        out = kept.select("row.*")
    return out
