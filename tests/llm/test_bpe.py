"""Operator 7 against the tiktoken library and by round trips."""

import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

from lapse.llm import bpe
from lapse.llm.queries import QUERIES

from .conftest import DOCS, SF001, WORD

PATH, PATTERN = bpe.default_vocabulary()


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(3)
    letters = list("abcdefghiABC  \n\t\r'sltd.,!?123 éüñß中文字\x1c\x1f\x85\xa0​　😀\x00<|>")
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(800)]
    return out + ["a" * 3000, " " * 1000, "ab" * 400 + "\n\n\n x", "don't I'll  \n\n", "", None, "<|endoftext|> <|end|>", "x \x1c y\x1cz",
                  "".join(rng.choice("abcde") for _ in range(5000)), "word " * 3000]


def test_encode_like_the_library(reference):
    codec, texts = bpe.Bpe(PATH, PATTERN), odd_texts()
    for part in (texts[:400], texts[400:]):
        ids, edges = codec.encode(part)
        for i, t in enumerate(part):
            assert ids[edges[i] : edges[i + 1]].tolist() == reference.encode_ordinary(t or "")
        data, to = codec.decode(ids, edges)
        assert [data[a:z].tobytes() for a, z in zip(to, to[1:])] == [(t or "").encode() for t in part]


def test_forgetting_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    codec, texts = bpe.Bpe(PATH, PATTERN), odd_texts()
    for t in texts[:60]:
        ids, edges = codec.encode([t, "again"])
        assert ids[: edges[1]].tolist() == reference.encode_ordinary(t or "")


def test_rows_and_long_matches_agree():
    codec, rng = bpe.load(PATH, PATTERN), random.Random(1)
    pieces = ["".join(rng.choice("abehinort é") for _ in range(n)).encode() for n in list(range(1, 64)) * 3]
    ids, edges = codec.merge_all(pieces)
    for i, p in enumerate(pieces):
        want = [codec.ranks[p]] if p in codec.ranks else codec.merge_long(p)
        assert ids[edges[i] : edges[i + 1]].tolist() == want


def test_query_like_the_library(spark, documents, reference):
    got = sorted(tuple(r) for r in QUERIES["op7_bpe"](spark, SF001).collect())
    want = []
    for r in documents[1]:
        ids = reference.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_columns_and_round_trip(spark, odd, reference):
    df = odd[0].withColumnRenamed("lang", "row").withColumnRenamed("source", "n_tokens_")
    enc = bpe.encode_text(df)
    assert enc.columns == ["doc_id", "row", "n_tokens_", "n_chars", "ids"]
    assert sorted((str(r.doc_id), list(r.ids)) for r in enc.collect()) == sorted((str(r[0]), reference.encode_ordinary(r[1] or "")) for r in odd[1])
    back = bpe.decode_ids(enc)
    assert back.columns == ["doc_id", "row", "n_tokens_", "n_chars", "text"]
    assert sorted((str(r.doc_id), bytes(r.text).decode()) for r in back.collect()) == sorted((str(r[0]), r[1] or "") for r in odd[1])
    checked = bpe.encode_checked(df)
    assert checked.columns == ["doc_id", "row", "n_tokens_", "n_chars", "ids", "n_tokens", "decoded_sha256"] and checked.count() == len(odd[1])


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert bpe.encode_text(empty).collect() == [] and bpe.round_trip_digest(empty).collect() == [] and bpe.encode_checked(empty).collect() == []
    assert bpe.encode_text(empty.select("text")).columns == ["ids"]
