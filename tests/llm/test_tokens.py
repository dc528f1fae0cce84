"""Operator 10: flat files, block borders and the prefix scan."""

import gzip
import random
from collections import Counter

import numpy as np
import pytest

from lapse.llm import bpe, tokens
from lapse.llm.queries import QUERIES

from .conftest import DOCS, SF001


def counted(spark, path, **how):
    rows = tokens.token_counts(spark, path, **how).collect()
    by = {}
    for r in rows:
        by.setdefault(r.file, []).append(r)
    for part in by.values():  # ordinals and places without gaps
        part.sort(key=lambda r: r.ordinal)
        assert [r.ordinal for r in part] == list(range(len(part)))
        at = 0
        for r in part:
            assert r.first_token == at
            at += r.n_tokens + 1
    return rows


def test_query_counts_every_document(spark, documents):
    codec = bpe.load(*bpe.default_vocabulary())
    want = Counter(np.diff(codec.encode([r.text for r in documents[1]])[1]).tolist())
    got = QUERIES["op10_token_counts"](spark, SF001).collect()
    assert Counter(r.n_tokens for r in got) == want and all(r.complete for r in got)


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_documents_across_blocks_and_files(spark, odd, block):
    path = tokens.new_flat_path(spark)
    df = odd[0].filter("doc_id is null or doc_id <> 6") if block == 1 else odd[0]
    tokens.write_flat(df.withColumn("file", df.n_chars), path, file_bytes=500)
    codec = bpe.load(*bpe.default_vocabulary())
    want = Counter(np.diff(codec.encode([r.text for r in df.collect()])[1]).tolist())
    rows = counted(spark, path, block=block)
    assert Counter(r.n_tokens for r in rows) == want and all(r.complete for r in rows)


def test_files_from_elsewhere(spark, tmp_path):
    rng = random.Random(2)
    want = []
    for k in range(6):
        docs = [rng.choice([0, 0, 1, 3, 50]) for _ in range(rng.randint(0, 12))]
        ids = [x for n in docs for x in [*[rng.randrange(50_000) for _ in range(n)], tokens.END]]
        cut = rng.randint(0, 3)
        ids += [5] * cut
        data = np.array(ids, ">u2").tobytes() + (b"\x01" if k == 2 else b"")
        (tmp_path / f"f{k}.bin{'.gz' if k % 2 else ''}").write_bytes(gzip.compress(data[:40]) + gzip.compress(data[40:]) if k % 2 else data)
        want += [(n, True) for n in docs] + ([(cut, False)] if cut else [])
    for block in (1, 4, 10_000):
        got = [(r.n_tokens, r.complete) for r in counted(spark, f"file://{tmp_path}", block=block)]
        assert Counter(got) == Counter(want)


def test_empty_table(spark):
    path = tokens.new_flat_path(spark)
    tokens.write_flat(spark.createDataFrame([(1, None, None, None, None), (2, "", "", "", 0)], DOCS), path)
    assert [(r.n_tokens, r.complete) for r in counted(spark, path)] == [(0, True), (0, True)]
