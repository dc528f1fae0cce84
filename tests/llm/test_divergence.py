import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lapse.llm import divergence
from lapse.llm.queries import QUERIES, SQL
from tests.llm.conftest import DOCS, SF001, prose

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=30, top=50):
    """(lang, source, part, item, value, rank) by the definition, over dense counts."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        v = len(kept)
        whole = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})

        def p(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * v) for t in kept}

        of, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for s in sources:
            pairs = [(sum(abs(of[s][t] - of[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(of[s][t] - q[t], t) for t in kept if counts[lang, s][t] > 0 and of[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("tile_terms", [7, 4096])
def test_equals_brute_force(spark, documents, tile_terms):
    df, rows = documents
    want = brute([tuple(r) for r in rows], min_docs=5)
    assert got(divergence.divergence(df, min_docs=5, tile_terms=tile_terms)) == want
    assert any(r[2] == "term" for r in want)


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    rel = con.sql(SQL["op11_divergence"])
    out = QUERIES["op11_divergence"](spark, SF001)
    assert sorted(rel.columns) == sorted(out.columns)
    cols = sorted(out.columns)
    assert sorted(tuple(r) for r in out.select(*cols).collect()) == sorted(rel.project(", ".join(cols)).fetchall())


def test_more_groups_than_one_block(spark):
    """150 sources: three row blocks, so tiles of two blocks; some sources have no term, one holds a third."""
    rows = [(i, " ".join(prose(20, i, 60)) if i % 7 else "123 _ !", "en", f"s{i % 150 if i % 3 else 0}", 0) for i in range(900)]
    out = divergence.divergence(spark.createDataFrame(rows, DOCS), min_docs=3, tile_terms=20)
    assert got(out) == brute(rows, min_docs=3)


def test_odd_rows_and_clashing_columns(spark, odd):
    df, rows = odd
    want = brute(rows, min_docs=2)
    assert got(divergence.divergence(df, min_docs=2)) == want
    more = df.withColumns({"term": F.lit(1), "n": F.lit("x"), "value": F.lit(None), "row": F.lit(0), "a.b": F.lit(2)})
    assert got(divergence.divergence(more, min_docs=2)) == want
    # nothing kept: pairs of value 0, no terms
    bare = got(divergence.divergence(df, min_docs=10**6))
    assert bare and all(r[2] == "pair" and r[4] == 0 for r in bare)


def test_empty_table(spark):
    assert divergence.divergence(spark.createDataFrame([], DOCS)).collect() == []


def test_tree_skips_zero_quadrants_only():
    rng = np.random.default_rng(3)
    for same in (True, False):
        one = rng.random((64, 37)) < 0.02
        two = one if same else rng.random((64, 37)) < 0.02
        a, b, c = divergence.joint_leaves(divergence.Quadtree(one), divergence.Quadtree(two), same)
        want = {(x, y, z) for z in range(37) for x in range(64) for y in range(x + 1 if same else 0, 64) if one[x, z] or two[y, z]}
        assert len(a) == len(want) and set(zip(a.tolist(), b.tolist(), c.tolist())) == want


def test_share_is_exact_beyond_doubles(spark):
    n, total, v = 9_007_199_254_740_993, 9_007_199_254_740_999, 3
    df = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(v)).alias("p"))
    assert df.first().p == 1 + 10**9 * (n + 5) // (total + 5 * v)
