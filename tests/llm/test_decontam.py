"""Operator 2 against a brute-force search of every item-sized window."""

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc

from lapse.llm import decontam as d
from lapse.llm.queries import QUERIES

from .conftest import DOCS, SF001, WORD, prose


def brute(docs, items, percent=80):
    low = lambda t: WORD.findall(pc.utf8_lower(pa.array([t or ""]))[0].as_py())
    grams = lambda w: Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
    out = {}
    for doc_id, text in docs:
        w = low(text)
        have = set(grams(w))
        for item_id, item in items:
            b = low(item)
            if len(b) < d.MIN_WORDS:
                if b and any(w[p : p + len(b)] == b for p in range(len(w) - len(b) + 1)):
                    out[doc_id, item_id] = 1.0
                continue
            if not have & set(grams(b)):
                continue
            want, best = grams(b), 0.0
            for p in range(max(1, len(w) - len(b) + 1)):
                part = grams(w[p : p + len(b)])
                both = sum((part & want).values())
                best = max(best, both / (sum(part.values()) + sum(want.values()) - both))
            if 100 * best >= percent:
                out[doc_id, item_id] = round(best, 9)
    return out


def test_query_against_brute_force(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = brute([(r.doc_id, r.text) for r in documents[1]], items)
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in QUERIES["op2_decontamination"](spark, SF001).collect()}
    assert got == want and want


def planted(spark):
    item = " ".join(prose(40, 9))
    rows = [
        (1, " ".join(prose(50, 1)) + " " + item + " " + " ".join(prose(50, 2)), "en", "a", 1),
        (2, " ".join(prose(33, 3)) + "\n" + item.upper(), "en", "a", 1),
        (3, " ".join(item.split()[:36]), None, None, None),  # 32 of 36 shingles
        (4, " ".join(item.split()[:20]), "en", "a", 1),  # half of it: no leak
        (5, " ".join(prose(400, 4)), "en", "a", 1), (None, item, "en", "a", 1), (7, None, "en", "a", 1), (8, "", "en", "a", 1),
        (9, (item + " ") * 3, "en", "a", 1), (9, (item + " ") * 3, "en", "a", 1),
    ]
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (5, item), (None, " ".join(prose(30, 77)))], "item_id long, text string")
    return spark.createDataFrame(rows, DOCS), bench


def test_planted_cases(spark):
    docs, bench = planted(spark)
    got = Counter((r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect())
    assert got == Counter({(k, i): (2 if k == 9 else 1) for k in (1, 2, 3, None, 9) for i in (1, 5)})
    left = d.remove_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [4, 5, 7, 8]


def test_chunks_of_the_benchmark_give_the_same(spark):
    docs, bench = planted(spark)
    rows = lambda c: sorted(map(str, d.contaminated(docs, bench, chunk_words=c).collect()))
    assert rows(30) == rows(10**6)
    assert d.remove_contaminated(docs, bench, chunk_words=30).count() == 4


def test_empty_tables_and_clashing_columns(spark):
    docs, bench = planted(spark)
    assert d.contaminated(spark.createDataFrame([], DOCS), bench).collect() == []
    assert d.contaminated(docs, bench.limit(0)).collect() == []
    assert d.remove_contaminated(docs, bench.limit(0)).count() == docs.count()
    other = docs.withColumnRenamed("lang", "row").withColumnRenamed("source", "item_id")
    assert d.remove_contaminated(other, bench).columns == other.columns
    assert d.remove_contaminated(other, bench).count() == 4


def test_blocks_find_every_print_within_the_radius():
    import numpy as np

    rng = np.random.default_rng(2)
    prints = rng.integers(0, 2**64, 200, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, d.RADIUS + 3), replace=False))) for _ in range(200)]
    seen = prints ^ np.array(flips)
    order, edges = [], []
    for j in range(d.RADIUS + 1):
        block = ((prints >> np.uint64(d.BLOCK_BITS * j)) & np.uint64((1 << d.BLOCK_BITS) - 1)).astype(np.int64)
        order.append(np.argsort(block, kind="stable"))
        edges.append(np.concatenate([[0], np.cumsum(np.bincount(block, minlength=1 << d.BLOCK_BITS))]))
    c = d.Class(8, 2, prints, np.arange(200), np.zeros(200), order, edges)
    w, o = d.near_prints(c, seen)
    want = {(i, k) for i in range(200) for k in range(200) if bin(int(seen[i] ^ prints[k])).count("1") <= d.RADIUS}
    assert set(zip(w.tolist(), o.tolist())) == want


def test_words_changed_within_items():
    """Copies with single words changed in the middle, at any place of a document, as brute force finds them."""
    docs, items = [], []
    for n, edits in ((50, 1), (60, 1), (80, 1), (100, 2), (200, 3), (50, 2), (30, 1)):
        for k in range(12):
            i = len(items)
            item = prose(n, 1000 + i, 3000)
            copy = list(item)
            for e in range(edits):
                copy[(e + 1) * n // (edits + 1) + k % 3] = f"changed{i}_{e}"
            items.append((i, " ".join(item)))
            docs.append((i, " ".join(prose(31 + 7 * k, 5000 + i, 3000) + copy + prose(40, 7000 + i, 3000))))
    docs.append((len(docs), " ".join(prose(25, 8, 3000) + items[0][1].split()[1:] * 5)))
    index = d.build_index(items)
    got = {(r, i): round(v, 9) for r, i, _, v in d.find(pa.array([t for _, t in docs]), index)}
    assert got == brute(docs, items)
    assert set((i, i) for i in range(60)) <= set(got)
    assert d.find(pa.array(["a b c", None]), index) == []


def test_fingerprints_alone_find_edited_items():
    """Recall of the SimHash path without the other one: copies at the similarity with words changed, put in or taken out."""
    import random

    rng, docs, items = random.Random(5), [], []
    for n in (12, 20, 30, 50, 80, 120, 200):
        for _ in range(30):
            i = len(items)
            item = prose(n, 20_000 + i, 3000)
            copy = list(item)
            for e in range(rng.randint(0, max(1, n // 45))):
                at, how = rng.randrange(len(copy)), rng.randrange(3)
                copy[at : at + (how != 1)] = [] if how == 2 else [f"new{i}_{e}"]
            items.append((i, " ".join(item)))
            docs.append((i, " ".join(prose(rng.randint(0, 90), 30_000 + i, 3000) + copy + prose(40, 40_000 + i, 3000))))
    index = d.build_index(items)
    want = {(r, i) for r, i, _, _ in d.find(pa.array([t for _, t in docs]), index)}
    index.seed_head[:] = False
    got = {(r, i) for r, i, _, _ in d.find(pa.array([t for _, t in docs]), index)}
    assert len(want) > 150 and want == set(brute(docs, items)) and got <= want and len(got) >= 0.98 * len(want)


def test_short_items_are_found_as_sequences():
    items = [(1, "Five short words in all"), (2, "five short words in all"), (3, "seven words are one less than eight"), (4, "one two"), (5, " ")]
    docs = [(0, "here FIVE short words\nin all and five short words in all"), (1, "five short words at all one"), (2, "two one two"),
            (3, "x seven words are one less than eight y"), (4, "one"), (5, None), (6, "two five short words in")]
    got = d.find(pa.array([t for _, t in docs], pa.string()), d.build_index(items))
    assert {(r, [1, 2, 3, 4, 5][i]): v for r, i, _, v in got} == brute(docs, items)
    assert sorted((r, i, s) for r, i, s, _ in got) == [(0, 0, 1), (0, 1, 1), (2, 3, 1), (3, 2, 1)]


def test_any_column_name_is_carried(spark):
    docs, bench = planted(spark)
    other = docs.withColumnRenamed("lang", "a.b").withColumnRenamed("source", "c`d")
    out = d.remove_contaminated(other, bench)
    assert out.columns == other.columns and out.count() == 4
