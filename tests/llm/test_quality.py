"""Operator 5: features against Python, sketches and fences, the verdict against SQL."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lapse.llm import quality as q
from lapse.llm.queries import QUERIES, SQL
from lapse.sources.store import materialize

from .conftest import DOCS, SF001, WORD, prose


def features(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
    cover = np.zeros(len(w), bool)
    for j in range(len(w) - 4):
        if grams[tuple(w[j : j + 5])] > 1:
            cover[j : j + 5] = True
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), int(cover.sum()))


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    want = con.sql(SQL["op5_quality"])
    got = QUERIES["op5_quality"](spark, SF001)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_features_of_odd_rows(spark, odd):
    extra = [(20, "a b c d e a b c d e a b c d e", "x", "y", 1), (21, "l one\n l one\nl one\n\n \nl one", "x", "y", 1), (22, "# * $%&|<> #a", "x", "y", 1)]
    df = odd[0].unionByName(spark.createDataFrame(extra, DOCS))
    rows = df.collect()
    got = q.features(df).collect()
    assert sorted((r.doc_id, *(r[f] for f in q.FEATURES)) for r in got if r.doc_id is not None) == sorted(
        (r.doc_id, *features(r.text)) for r in rows if r.doc_id is not None)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)


def test_buckets_are_monotone_and_tight(spark):
    n = list(range(2000)) + [2**k + d for k in range(11, 50) for d in (-1, 0, 1)]
    rows = spark.createDataFrame([(x,) for x in sorted(n)], "v long").select("v", q.bucket(F.col("v")).alias("b")).withColumn("low", q.bucket_low(F.col("b"))).collect()
    assert all(a.b <= z.b for a, z in zip(rows, rows[1:]))
    assert all(r.low <= r.v < r.low + max(1, r.low / 15) for r in rows)


def test_sketches_merge_to_quantiles(spark):
    vals = [(x * 37 % 1000, "en", f"s{x % 3}") for x in range(3000)]
    df = spark.createDataFrame([(v, 1000, 0, 1, 0, 0, False, la, s) for v, la, s in vals],
                               "n_symbols long, n_words long, word_chars long, n_lines long, n_dup_lines long, n_repeat_words long, base_failed boolean, lang string, source string")
    got = q.quantiles(q.sketches(df, "lang", "source"), ["lang"]).filter("ratio = 'symbols'").first()
    assert got.total == 3000 and abs(got.decile - 100) <= 100 / 16 and abs(got.median - 500) <= 500 / 16


def corpus(spark):
    rows, i = [], 0
    for source in ("news", "shop"):
        for k in range(40):
            rows.append((i, " ".join(prose(60, i)), "en", source, 1)); i += 1
    rows.append((900, " ".join(w + "###" for w in prose(60, 900)), "en", "news", 1))
    rows.append((901, " ".join(w + "thisisoneverylongword" for w in prose(60, 901)), "en", "news", 1))
    rows.append((902, "\n".join(["buy now and here"] + [" ".join(prose(5, s)) for s in range(3)] + ["buy now and here"] * 4), None, None, 1))
    rows += [(903, None, "en", "news", 1), (904, "", None, "news", 0), (905, "too few words", "en", "shop", 1)]
    return spark.createDataFrame(rows, DOCS)


def test_outliers_go_and_clean_documents_stay(spark):
    out = q.judged(corpus(spark), carry=["doc_id"], min_rows=30).collect()
    lost = sorted(r.doc_id for r in out if not r.kept)
    assert lost == [900, 901, 902, 903, 904, 905]


def test_fences_follow_the_group(spark):
    """A source whose normal texts hold symbols keeps them; elsewhere the same text is an outlier."""
    rows = [(i, " ".join(w + ("#" if k % 2 else "") for k, w in enumerate(prose(80, i))), "en", "code", 1) for i in range(60)]
    rows += [(100 + i, " ".join(prose(80, 100 + i)), "en", "news", 1) for i in range(60)]
    rows.append((999, rows[0][1], "en", "news", 1))
    out = q.judged(spark.createDataFrame(rows, DOCS), carry=["doc_id"], min_rows=50).collect()
    assert sorted(r.doc_id for r in out if not r.kept) == [999]


def test_clashing_columns_and_empty_table(spark):
    df = corpus(spark).withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(-1)).withColumn("_words", F.lit(2))
    out = q.keep_good(df, min_rows=30)
    assert out.columns == df.columns and out.count() == 80
    assert {r.kept for r in out.collect()} == {"mine"}
    assert q.keep_good(spark.createDataFrame([], DOCS)).collect() == []


def test_no_python_in_the_plan(spark, documents):
    plan = q.judged(documents[0])._jdf.queryExecution().toString() + q.features(documents[0])._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_fences_are_the_groups_own(spark):
    """Most groups have fences that no other group has, and repeats are cut below the base limit."""
    docs = spark.read.parquet(f"{SF001.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = q.fences(q.sketches(materialize(q.features(docs), "test-features"), "lang", "source")).collect()
    seen = [tuple(v for k, v in r.asDict().items() if k not in ("lang", "source")) for r in rows]
    assert len({s for s in seen if seen.count(s) == 1}) > len(rows) / 2
    assert all(r.repeats_high < 200 for r in rows)


def test_every_rule_rejects(spark):
    """One row beyond each fence and within the base rules, in a group that is large enough to have its own."""
    rows = [(i, "\n".join(" ".join(prose(12, 20 * i + k)) for k in range(5)), "en", "a", 1) for i in range(60)]
    lines = rows[0][1].split("\n")
    words = " ".join(prose(100, 9000)).split()
    odd = [
        (900, " ".join(w + ("#" if k % 10 == 0 else "") for k, w in enumerate(words)), "en", "a", 1),
        (901, " ".join(w + "long" for w in words), "en", "a", 1),
        (902, " ".join(chr(0x4E00 + k) for k in range(100)), "en", "a", 1),
        (903, "\n".join([*lines, "one", "one", "one", "one", "one"]), "en", "a", 1),
        (904, " ".join(words[:91] + words[:9]), "en", "a", 1),
    ]
    out = {r.doc_id: r for r in q.judged(spark.createDataFrame(rows + odd, DOCS), carry=["doc_id"], min_rows=20).collect()}
    assert sorted(k for k, r in out.items() if not r.kept) == [900, 901, 902, 903, 904]
    assert not any(r.base_failed for r in out.values())


def test_junk_does_not_widen_its_own_fence(spark):
    """A fifth of one group is junk: the fence follows the language, not the junk."""
    rows = [(i, " ".join(prose(60, i)), "en", f"s{i % 4}", 1) for i in range(200)]
    rows += [(1000 + i, " ".join(w + "##" for w in prose(60, 3000 + i)), "en", "s0", 1) for i in range(12)]
    out = q.judged(spark.createDataFrame(rows, DOCS), carry=["doc_id"], min_rows=20).collect()
    assert sorted(r.doc_id for r in out if not r.kept) == list(range(1000, 1012))


def test_any_column_name_is_carried(spark):
    df = corpus(spark).withColumn("a.b", F.lit(1)).withColumn("_quality_kept", F.lit("x")).withColumn("_QUALITY_n_words", F.lit(3))
    out = q.keep_good(df, min_rows=30)
    assert out.columns == df.columns and out.count() == 80
