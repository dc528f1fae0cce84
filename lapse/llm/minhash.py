"""Operator 4: near-duplicates by one-permutation MinHash.

1. Each text becomes its set of distinct k-word shingles (64-bit hashes), and one permutation
   of the hash space is cut into ``BINS`` equal bins; the smallest hash of each bin is kept.
   Empty bins are filled by optimal densification: bin i draws bins by a fixed 2-universal
   sequence until it meets a non-empty one.
2. ``BANDS`` runs of ``BINS / BANDS`` bins are hashed to bucket keys.  Texts with equal sets
   share one class, so a group of copies enters the buckets once.
3. Every bucket yields stars: its members are paired with its smallest class, its largest and two
   that a hash picks, so n classes give fewer than 4n candidates.
4. Candidates are confirmed on the full shingle sets (``100 * |A n B| >= percent * |A u B|``)
   and linked into connected components.
5. Buckets that still span several components are compared whole, without pairs as rows: buckets that share
   classes form clusters, a cluster's classes are dealt into blocks of bounded size (its largest component apart
   from the others), and one task takes two blocks and counts all shared shingles of their members at once.  The
   largest component is not compared with itself, so a class moves once per block of the others.

Defined cases: null and wordless texts have the empty set and link with nothing; a text of
fewer than k words has its word sequence as the one shingle; rows of one ``doc_id`` with
different texts belong to one node, and each links through its own text; a null ``doc_id`` takes
the component of its text's class and is never ``kept``; an empty table gives an empty result;
further columns are ignored by the labels and carried through by ``dedup``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.components import connected_components
from lapse.llm.names import quoted
from lapse.llm.words import mix64, ranges, shingle_sets, slices
from lapse.sources.store import materialize

BINS, BANDS = 240, 40
PERCENT = 80
#: classes and shingles of a block: what a task holds of a crowded cluster is two of them
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 2_000_000
DENSE_COLUMNS, SPARSE_PAIRS, DENSE_SHARE = 2048, 1 << 22, 50
U = np.uint64


def _densify(values: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Optimal densification of (texts x bins): an empty bin copies the first non-empty bin of
    its own fixed pseudo-random sequence, the same sequence for every text."""
    out = values.copy()
    row, col = np.nonzero(~filled)
    attempt = 0
    while len(row):
        attempt += 1
        draw = mix64(col.astype(np.uint64) * U(1_000_003) + U(attempt), 11) % U(values.shape[1])
        draw = draw.astype(np.int64)
        ok = filled[row, draw]
        out[row[ok], col[ok]] = values[row[ok], draw[ok]]
        row, col = row[~ok], col[~ok]
    return out


def band_keys(owner: np.ndarray, hashes: np.ndarray, size: np.ndarray, bins: int, bands: int) -> np.ndarray:
    """(texts x bands) bucket keys; texts with an empty set get zeros."""
    n = len(size)
    # The mixed hash is the one permutation; bins are equal ranges of it, so in hash order the
    # first hash of every (text, bin) is the smallest one.
    cell = owner * bins + (((hashes >> U(32)) * U(bins)) >> U(32)).astype(np.int64)
    head = np.ones(len(cell), bool)
    head[1:] = cell[1:] != cell[:-1]
    sketch = np.zeros(n * bins, np.uint64)
    filled = np.zeros(n * bins, bool)
    sketch[cell[head]], filled[cell[head]] = hashes[head], True
    sketch, filled = sketch.reshape(n, bins), filled.reshape(n, bins)
    some = np.flatnonzero(size > 0)
    out = np.zeros((n, bands), np.uint64)
    if len(some):
        dense = _densify(sketch[some], filled[some]).reshape(len(some), bands, bins // bands)
        key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(some), bands))
        for j in range(bins // bands):
            key = mix64(key ^ dense[:, :, j], 5)
        out[some] = key
    return out


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2,
               bins: int = BINS, bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, keys): set size, a 128-bit hash of the set, and its bucket keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            owner, h, size = shingle_sets(b.column(1), shingle)
            sums = []
            for seed in (21, 22):
                total = np.zeros(len(h) + 1, np.uint64)
                np.cumsum(mix64(h, seed), out=total[1:])
                to = np.cumsum(size)
                sums.append((total[to] - total[to - size]).view(np.int64))
            keys = band_keys(owner, h, size, bins, bands).view(np.int64)
            flat = pa.array(keys.reshape(-1), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * bands), flat)],
                names=["doc_id", "n_shingles", "s1", "s2", "keys"],
            )

    src = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>")


def shared_percent(shingle: int, percent: int):
    """Arrow function over (u, v, a, b): keep the pairs whose full sets pass the similarity test."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(slices(batches, "a"), "b"):
            oa, ha, na = shingle_sets(b.column("a"), shingle)
            ob, hb, nb = shingle_sets(b.column("b"), shingle)
            left, right = np.split(ha, np.cumsum(na)[:-1]), np.split(hb, np.cumsum(nb)[:-1])
            both = np.array([np.intersect1d(x, y, assume_unique=True).size for x, y in zip(left, right)])
            ok = (both > 0) & (100 * both >= percent * (na + nb - both))
            yield b.select(["u", "v"]).filter(pa.array(ok))

    return run


def confirm(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (u, v) of ids whose texts pass the test on their full shingle sets."""
    a = texts.select(F.col("doc_id").alias("_ia"), F.col("text").alias("a"))
    b = texts.select(F.col("doc_id").alias("_ib"), F.col("text").alias("b"))
    j = pairs.join(a, F.col("v") == F.col("_ia")).select("u", "v", "a")
    j = j.join(b, F.col("u") == F.col("_ib")).select("u", "v", "a", "b")
    return j.mapInArrow(shared_percent(shingle, percent), "u long, v long")


def candidates(member: DataFrame, percent: int) -> DataFrame:
    """Distinct (u, v) of the buckets' stars, from (rep, n_shingles, key).

    The hubs of a bucket are its smallest and largest class and two that a hash picks, so that a
    member far from one hub of a mixed bucket still meets others: at most four candidates a member.
    Pairs whose set sizes alone rule the link out are left out.
    """
    draw = [F.xxhash64("rep", F.lit(k)) for k in (1, 2)]
    picks = [(F.min("rep"), F.min_by("n_shingles", "rep")), (F.max("rep"), F.max_by("n_shingles", "rep"))]
    picks += [(F.min_by("rep", d), F.min_by("n_shingles", d)) for d in draw]
    stars = member.groupBy("key").agg(
        *[c.alias(f"{name}{i}") for i, pick in enumerate(picks) for name, c in zip(("h", "n"), pick)]).filter("h0 <> h1")
    stars = stars.select("key", F.array(*[F.struct(F.col(f"h{i}").alias("hub"), F.col(f"n{i}").alias("n")) for i in range(len(picks))]).alias("hubs"))
    fits = lambda x: (x.hub != F.col("rep")) & (
        100 * F.least(F.col("n_shingles"), x.n) >= percent * F.greatest(F.col("n_shingles"), x.n))
    pairs = member.join(stars, "key").select("rep", F.explode(F.array_distinct(F.filter("hubs", fits))).alias("x"))
    return pairs.select(F.least("x.hub", "rep").alias("u"), F.greatest("x.hub", "rep").alias("v")).distinct()


def several(member: DataFrame, labels: DataFrame, least: int) -> DataFrame:
    """The rows of ``member`` with their component, in buckets of ``least`` classes or more that span several."""
    label = labels.select(F.col("node").alias("rep"), "component")
    m = member.join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    spans = m.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    return m.join(spans.filter(f"lo <> hi and n >= {least}").select("key", "n"), "key")


def shared_counts(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int, m: int) -> np.ndarray:
    """(n x m) sizes of the intersections of two lists of sets, each given as (set number, hash) of its elements.

    Hashes that many sets of both sides hold are columns of a matrix product, the others are expanded."""
    tokens = np.intersect1d(a[1], b[1])
    out = np.zeros(n * m, np.float32)
    if not len(tokens):
        return out.reshape(n, m).astype(np.int64)
    sides = []
    for owner, h in (a, b):
        at = np.minimum(np.searchsorted(tokens, h), len(tokens) - 1)
        hit = tokens[at] == h
        owner, at = owner[hit], at[hit]
        order = np.argsort(at, kind="stable")
        sides.append((owner[order], at[order], np.bincount(at, minlength=len(tokens))))
    (oa, ta, fa), (ob, tb, fb) = sides
    many = fa * fb > n * m // DENSE_SHARE
    column = np.cumsum(many) - 1
    for k in range(0, int(many.sum()), DENSE_COLUMNS):
        parts = []
        for owner, t, rows in ((oa, ta, n), (ob, tb, m)):
            use = many[t] & (column[t] >= k) & (column[t] < k + DENSE_COLUMNS)
            x = np.zeros((rows, DENSE_COLUMNS), np.float32)
            x[owner[use], column[t[use]] - k] = 1
            parts.append(x)
        out += (parts[0] @ parts[1].T).ravel()
    few = ~many[ta]
    oa, ta = oa[few], ta[few]
    first = np.cumsum(fb) - fb
    total = np.cumsum(fb[ta])
    at = 0
    while at < len(ta):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SPARSE_PAIRS, side="right")))
        t = ta[at:to]
        cell = np.repeat(oa[at:to] * m, fb[t]) + ob[ranges(first[t], fb[t])]
        out += np.bincount(cell, minlength=n * m)
        at = to
    return out.reshape(n, m).astype(np.int64)


def _block_links(percent: int):
    """Of two blocks (or one with itself), a link for every two components that one of its pairs joins."""

    def run(table):
        side = table["side"].to_numpy()
        rep, component = table["rep"].to_numpy(), table["component"].to_numpy()
        hashes = table["hashes"].combine_chunks()
        size = np.diff(hashes.offsets.to_numpy())
        owner, h = np.repeat(np.arange(len(rep)), size), hashes.flatten().to_numpy()
        left = np.flatnonzero(side <= 1)    # 0: both sides, 1: left, 2: right
        right = np.flatnonzero(side != 1)
        number = np.zeros((2, len(rep)), np.int64)
        number[0, left], number[1, right] = np.arange(len(left)), np.arange(len(right))
        of = lambda k, mine: (number[k, owner[mine]], h[mine])
        both = shared_counts(of(0, side[owner] <= 1), of(1, side[owner] != 1), len(left), len(right))
        union = size[left][:, None] + size[right][None, :] - both
        ok = (both > 0) & (100 * both >= percent * union) & (component[left][:, None] != component[right][None, :])
        x, y = np.nonzero(ok)
        u, v = rep[left[x]], rep[right[y]]
        joined = np.sort(np.stack([component[left[x]], component[right[y]]], axis=1), axis=1)
        _, one = np.unique(joined, axis=0, return_index=True)
        return pa.table({"u": u[one], "v": v[one]})

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            _, h, size = shingle_sets(b.column("text"), shingle)
            edge = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            kept = [i for i, name in enumerate(b.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in kept], pa.ListArray.from_arrays(pa.array(edge), pa.array(h.view(np.int64)))],
                names=[*[b.schema.names[i] for i in kept], "hashes"])

    return run


def crowded_links(crowded: DataFrame, texts: DataFrame, shingle: int, percent: int,
                  block_classes: int = BLOCK_CLASSES, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links (u, v) between the components of the buckets ``crowded`` (rep, n_shingles, key, component): every two
    classes of one bucket and different components are compared on their full sets."""
    hub = crowded.groupBy("key").agg(F.min("rep").alias("hub"))
    edges = crowded.join(hub, "key").select(F.col("rep").alias("u"), F.col("hub").alias("v")).filter("u <> v").distinct()
    cluster = connected_components(edges).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    who = materialize(crowded.select("rep", "component", "n_shingles").distinct().join(cluster, "rep"), "minhash-clusters")
    parts = who.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    whole = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.max(F.struct("n", "component", "s")).alias("big"))
    blocks = lambda n, s: F.greatest(F.ceil(n / block_classes), F.ceil(s / block_shingles)).cast("int")
    plan = whole.select("cluster", F.col("big.component").alias("largest"), blocks(F.col("big.n"), F.col("big.s")).alias("n_big"),
                        blocks(F.col("n") - F.col("big.n"), F.col("s") - F.col("big.s")).alias("n_rest")).filter("n_rest > 0")
    in_big = F.col("component") == F.col("largest")
    block = F.pmod(F.xxhash64("rep", F.lit(9)), F.when(in_big, F.col("n_big")).otherwise(F.col("n_rest"))).cast("int")
    placed = who.join(plan, "cluster").select("rep", "component", "cluster", "n_big", "n_rest", in_big.alias("in_big"), block.alias("block"))
    sets = placed.join(texts, F.col("rep") == F.col("doc_id")).drop("doc_id").mapInArrow(
        _sets(shingle), "rep long, component long, cluster long, n_big int, n_rest int, in_big boolean, block int, hashes array<long>")
    # the others' blocks meet each other and every block of the largest component
    to = lambda i, j, kind, side: F.struct(i.alias("i"), j.alias("j"), F.lit(kind).alias("kind"), side.alias("side"))
    up_to = lambda n: F.sequence(F.lit(0), n - 1)
    b = F.col("block")
    rest = F.concat(
        F.transform(up_to(F.col("n_rest")), lambda x: to(F.least(b, x), F.greatest(b, x), 0, F.when(x == b, 0).when(b < x, 1).otherwise(2))),
        F.transform(up_to(F.col("n_big")), lambda x: to(b, x, 1, F.lit(1))))
    big = F.transform(up_to(F.col("n_rest")), lambda x: to(x, b, 1, F.lit(2)))
    rows = sets.withColumn("to", F.explode(F.when(F.col("in_big"), big).otherwise(rest))).select("rep", "component", "hashes", "cluster", "to.*")
    return rows.groupBy("cluster", "i", "j", "kind").applyInArrow(_block_links(percent), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2,
                    percent: int = PERCENT, bins: int = BINS, bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    sig = materialize(signatures(docs, id_col, text_col, shingle, bins, bands), "minhash-sig")
    some = sig.filter("n_shingles > 0")
    classes = some.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    rows = materialize(
        sig.drop("keys").join(classes, ["s1", "s2"], "left").select("doc_id", "n_shingles", "s1", "s2", "rep"),
        "minhash-rows",
    )
    # one row per class and bucket; a null rep (no id in the class) has nothing to link by id
    one = some.join(classes.filter("rep is not null"), ["s1", "s2"]).filter("doc_id = rep")
    member = one.select("rep", "n_shingles", F.explode("keys").alias("key"))
    texts = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    pairs = materialize(candidates(member, percent), "minhash-candidates")
    # rows of one id whose texts are in several classes join these classes
    multi = (
        rows.filter("doc_id is not null and rep is not null").groupBy("doc_id")
        .agg(F.min("rep").alias("u"), F.max("rep").alias("top")).filter("u <> top").select("doc_id", "u")
    )
    same_id = rows.join(multi, "doc_id").select("u", F.col("rep").alias("v")).filter("u <> v")
    labels = connected_components(confirm(pairs, texts, shingle, percent).unionByName(same_id))
    # buckets of up to three classes were compared whole by their stars
    crowded = materialize(several(member, labels, 4).select("rep", "n_shingles", "key", "component"), "minhash-crowded")
    if not crowded.isEmpty():
        links = materialize(crowded_links(crowded, texts, shingle, percent), "minhash-links")
        labels = connected_components(labels.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(links))
    rep_label = labels.select(F.col("node").alias("rep"), "component")
    out = rows.join(rep_label, "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, **how) -> DataFrame:
    """``docs`` with one row left of each near-duplicate component: that of the smallest id.

    Rows without an id stay unless their text's class has an id; of fully repeated ids one
    row stays, the one with the smallest text.  Texts without words are never duplicates.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, **how)
    # of ids in several classes the one kept row is that of the smallest text
    gone, key = "_minhash_gone_" + uuid.uuid4().hex[:8], "_minhash_id_" + uuid.uuid4().hex[:8]
    lost = found.filter("doc_id is not null and not kept").select(F.col("doc_id").alias(key)).distinct().withColumn(gone, F.lit(True))
    left = docs.withColumn(key, quoted(id_col).cast("long"))
    out = left.join(lost, key, "left").filter(F.col(gone).isNull()).drop(gone)
    twice = found.filter("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.isEmpty():
        out = out.filter(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(out.filter(F.col(key).isNull()))
    return out.select(*[quoted(c) for c in docs.columns])
