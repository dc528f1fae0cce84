"""Operator 4 against brute force over all pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapse.llm import components, minhash
from lapse.llm.queries import QUERIES

from .conftest import DOCS, SF001, WORD, prose


def shingles(text, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(rows, k, percent=80):
    """{(doc_id, text): (n, component)} with ids as nodes."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    linked = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and linked(a, b):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    out = []
    for (i, s), (_, t) in zip(sets, rows):
        if i is None:
            same = [j for j, b in sets if j is not None and b == s and s]
            out.append((i, len(s), find(min(same)) if same else None, False))
        else:
            out.append((i, len(s), find(i), find(i) == i))
    return sorted(out, key=str)


def labels(df, **how):
    return sorted((tuple(r) for r in minhash.near_duplicates(df, **how).collect()), key=str)


def test_query_against_brute_force(spark, documents):
    got = sorted((tuple(r) for r in QUERIES["op4_minhash"](spark, SF001).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in documents[1]], 2)


def test_odd_rows(spark, odd):
    for k in (2, 5):
        assert labels(odd[0], shingle=k) == brute([r[:2] for r in odd[1]], k)


def near_copies(n, seed):
    """A base text and n copies with some words changed, at similarities around the threshold."""
    base, out = prose(200, seed, 3000), []
    for i in range(n):
        w = list(base)
        for j in range(i % 9):
            w[(37 * j + 11 * i) % 200] = f"x{i}_{j}"
        out.append(" ".join(w))
    return out


def test_group_of_near_copies(spark):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(near_copies(80, 3) + near_copies(40, 4) + [" ".join(prose(150, s)) for s in range(30)])]
    assert labels(spark.createDataFrame(rows, DOCS), shingle=2) == brute([r[:2] for r in rows], 2)


def test_star_bounds_the_pairs_of_a_hot_group(spark, monkeypatch):
    """A few candidates per class, whatever the size of its group."""
    seen = []
    keep = minhash.materialize
    monkeypatch.setattr(minhash, "materialize", lambda df, name, **k: seen.append((name, keep(df, name, **k))) or seen[-1][1])
    base = prose(200, 8, 3000)
    rows = [(i, " ".join(base[: i % 200] + [f"x{i}"] + base[i % 200 + 1 :]), "en", "a", 1) for i in range(400)]  # all pairs: 79,800
    rows += [(1000 + i, "the same text again and again", "en", "a", 1) for i in range(500)]
    out = minhash.near_duplicates(spark.createDataFrame(rows, DOCS), shingle=2)
    assert {r.component_id for r in out.select("component_id").distinct().collect()} == {0, 1000}
    first = next(df for name, df in seen if name == "minhash-candidates").count()
    assert 399 <= first < 20 * 400


def test_dedup_keeps_one_row_per_group_and_all_columns(spark, odd):
    df = odd[0].withColumnRenamed("lang", "kept").withColumnRenamed("source", "component_id")
    out = minhash.dedup(df, shingle=5)
    assert out.columns == df.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 9, 10, 11]
    assert minhash.dedup(spark.createDataFrame([], DOCS)).collect() == []


def test_empty_table(spark):
    assert labels(spark.createDataFrame([], DOCS)) == []
    assert labels(spark.createDataFrame([(1, None, None, None, None)], DOCS)) == [(1, 0, 1, True)]


def test_densified_bins_estimate_similarity():
    """Agreement of densified bins is an unbiased estimate, for short texts too."""
    for n in (30, 400):
        words = prose(n, 2, 10**6)
        other = words[: int(n * 0.9)] + prose(n - int(n * 0.9), 3, 10**6)
        a = pa.array([" ".join(words), " ".join(other)])
        o, h, size = minhash.shingle_sets(a, 1)
        x, y = set(h[o == 0].tolist()), set(h[o == 1].tolist())
        keys = minhash.band_keys(o, h, size, 4096, 4096)
        assert abs((keys[0] == keys[1]).mean() - len(x & y) / len(x | y)) < (0.1 if n == 30 else 0.05)


def test_components_of_paths_stars_and_loops(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 200)]
    edges += [(int(a), int(b)) for a, b in rng.integers(300, 400, (60, 2))] + [(1, 0), (None, 5)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        if a is not None and a != b:
            lo, hi = sorted((find(a), find(b)))
            parent[hi] = lo
    assert got == {x: find(x) for x in parent}
    assert components.connected_components(df.limit(0)).collect() == []


def test_twins_in_crowded_buckets(spark):
    """Texts of one template, too far apart to be linked, and a nearer twin of each."""
    base, texts = prose(400, 6, 10**6), []
    for i in range(150):
        rng = np.random.default_rng(i)
        w = list(base)
        for j in rng.choice(400, 14, replace=False):
            w[j] = f"t{i}_{j}"
        twin = list(w)
        for j in rng.choice(400, 20, replace=False):
            twin[j] = f"u{i}_{j}"
        texts += [w, twin]
    order = np.random.default_rng(5).permutation(300)
    rows = [(int(k), " ".join(t), "en", "a", 1) for k, t in zip(order, texts)]
    want = brute([r[:2] for r in rows], 2)
    assert len({c for _, _, c, _ in want}) > 140
    assert labels(spark.createDataFrame(rows, DOCS), shingle=2) == want


def test_shared_counts_equal_intersections(monkeypatch):
    """Common hashes (matrix product) and rare ones (expanded) together give every intersection."""
    monkeypatch.setattr(minhash, "DENSE_COLUMNS", 16)
    monkeypatch.setattr(minhash, "SPARSE_PAIRS", 40)
    rng = np.random.default_rng(4)
    sets = [set(rng.choice(60, rng.integers(0, 40), replace=False).tolist()) | set(rng.choice(10**6, 25).tolist()) for _ in range(30)]
    sets += [set(range(30)), set(), set(range(15, 80))]
    flat = lambda xs: (np.array([i for i, x in enumerate(xs) for _ in x], np.int64), np.array([h for x in xs for h in sorted(x)], np.int64))
    a, b = sets[:20], sets[12:]
    got = minhash.shared_counts(flat(a), flat(b), len(a), len(b))
    assert got.tolist() == [[len(x & y) for y in b] for x in a]
    assert minhash.shared_counts(flat([set()]), flat(b), 1, len(b)).tolist() == [[0] * len(b)]


@pytest.mark.parametrize("block", [5, 64])
def test_blocks_of_a_crowded_cluster_compare_all_its_pairs(spark, block):
    """All classes in one bucket, a third of them one component: the links join exactly the components that all
    pairs join, whatever the size of the blocks."""
    texts = near_copies(40, 3) + near_copies(25, 4) + near_copies(12, 9)[::3]
    rows = [(i, t) for i, t in enumerate(texts)]
    component = {i: (0 if i < 25 else i) for i in range(len(texts))}
    crowded = spark.createDataFrame([(i, 100, 7 + i % 2 if i else k, component[i]) for i in component for k in ((7, 8) if i == 0 else (0,))],
                                    "rep long, n_shingles long, key long, component long")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links = minhash.crowded_links(crowded, df, 2, 80, block_classes=block, block_shingles=2000 * block).collect()
    shingles = lambda t: set(zip(t.split(), t.split()[1:]))
    sets = [shingles(t) for t in texts]
    close = lambda i, j: 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    want = {tuple(sorted((component[i], component[j]))) for i in component for j in component if component[i] != component[j] and close(i, j)}
    assert all(close(r.u, r.v) for r in links)
    assert {tuple(sorted((component[r.u], component[r.v]))) for r in links} == want and want


def test_dedup_with_names_of_its_own_columns(spark, odd):
    df = odd[0].withColumn("_gone", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("_minhash_id", F.lit(3))
    out = minhash.dedup(df, shingle=5)
    assert out.columns == df.columns and out.count() == minhash.dedup(odd[0], shingle=5).count()
