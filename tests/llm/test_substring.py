"""Operator 6 against brute force over all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from lapse.llm import substring
from lapse.llm.queries import QUERIES
from lapse.llm.words import split_words

from .conftest import DOCS, SF001, WORD, prose


def kept_words(texts, k):
    words = [WORD.findall(t or "") for t in texts]
    times = Counter(tuple(w[j : j + k]) for w in words for j in range(len(w) - k + 1))
    out = []
    for w in words:
        keep = [True] * len(w)
        for j in range(len(w) - k + 1):
            if times[tuple(w[j : j + k])] > 1:
                keep[j : j + k] = [False] * k
        out.append([x for x, y in zip(w, keep) if y])
    return words, out


def brute(rows, k):
    words, kept = kept_words([t for _, t in rows], k)
    return sorted(
        ((i, len(w), len(w) - len(x), hashlib.sha256(" ".join(x).encode()).hexdigest()) for (i, _), w, x in zip(rows, words, kept)), key=str)


def digests(df, **how):
    return sorted((tuple(r) for r in substring.kept_digest(df, **how).collect()), key=str)


def test_query_against_brute_force(spark, documents):
    got = sorted((tuple(r) for r in QUERIES["op6_substring"](spark, SF001).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in documents[1]], 35)


@pytest.mark.parametrize("window,gram", [(35, 8), (12, 5), (5, 5), (3, 1)])
def test_odd_rows(spark, odd, window, gram):
    assert digests(odd[0], window=window, gram=gram) == brute([r[:2] for r in odd[1]], window)


def test_shared_passages(spark):
    passage = prose(50, 99)
    rows = [(i, " ".join(prose(20 + i, i) + passage[: 30 + i] + prose(5, 50 + i)), "en", "a", 1) for i in range(20)]
    rows += [(50, " ".join(prose(10, 7) + passage + prose(10, 8) + passage), "en", "a", 1), (51, "a " * 100, "en", "a", 1), (52, "a b " * 18, "en", "a", 1)]
    df = spark.createDataFrame(rows, DOCS)
    assert digests(df) == brute([r[:2] for r in rows], 35)
    assert digests(df, window=8, gram=3) == brute([r[:2] for r in rows], 8)


def test_remove_repeats_cuts_only_the_intervals(spark):
    shared = " ".join(prose(40, 1))
    left, right = "  Two\n\nlines  stay ", "\tand the rest\n"
    rows = [(1, left + shared + right, "en", "a", 1), (2, shared, "en", "b", 2), (3, " untouched \n text ", None, None, None), (4, None, "en", "a", 0)]
    df = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "spans").withColumnRenamed("source", "row")
    out = substring.remove_repeats(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "Two\n\nlines  stay and the rest", 2: "", 3: " untouched \n text ", 4: ""}


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert digests(empty) == [] and substring.remove_repeats(empty).collect() == []


def test_runs_hold_every_window_once():
    import pyarrow as pa

    texts = pa.array([" ".join(prose(300, 3)), None, "x " * 200, " ".join(prose(34, 1)), " ".join(prose(35, 2))])
    w = split_words(texts)
    doc, first, anchor, edges, full = substring.window_runs(w, 35, 8)
    at, h = w.windows(w.hashes(), 35)
    assert (full == h).all() and np.diff(edges).max() <= substring.RUN and edges[-1] == len(h)
    places = np.concatenate([w.first[d] + f + np.arange(n) for d, f, n in zip(doc, first, np.diff(edges))])
    assert (places == at).all()


def test_equal_runs_are_combined_with_all_their_owners():
    import pyarrow as pa

    text = " ".join(prose(200, 4))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(50), pa.int64()), pa.array([1] * 50, pa.int32()), pa.array([text] * 49 + ["x " + text])], names=["kid", "khash", "text"])
    out = next(substring._emit(35, 8)(iter([batch])))
    more = out.column("more")
    assert out.num_rows < 3 * 30 and sum(1 + (len(m) if m.is_valid else 0) for m in more) >= 49 * 7
    windows = sum(len(h) * (1 + (len(m) if m.is_valid else 0)) for h, m in zip(out.column("hashes"), more))
    assert windows == 49 * 166 + 167


def test_sliding_min():
    x = np.random.default_rng(0).integers(0, 1000, 200).astype(np.uint64)
    for width in (1, 2, 3, 7, 28, 200):
        assert (substring.sliding_min(x, width) == [x[i : i + width].min() for i in range(len(x) - width + 1)]).all()
