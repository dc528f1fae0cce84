"""The corpus pipeline against brute force, stage by stage, and its registration."""

import hashlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline as C

from .conftest import DOCS, SF001, WORD, prose
from .test_decontam import brute as leaks
from .test_minhash import brute as groups
from .test_substring import kept_words


def test_registration():
    names = list(entry.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{k}" for k in range(1, 14)] and "pipeline" in names
    assert [n for n, _ in C.STAGES] == ["quality rules", "MinHash near-dedup", "substring dedup", "benchmark decontamination", "byte-level BPE"]


def test_stages_against_brute_force(spark, documents, tmp_path):
    docs, _ = documents
    seen = [docs]
    for k, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, seen[-1], SF001)
        assert k == 4 or out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        seen.append(spark.read.parquet(f"{tmp_path}/{k}"))
    ids = [sorted(r.doc_id for r in s.select("doc_id").collect()) for s in seen]
    kept = entry.queries()["op5_quality"](spark, SF001).filter("kept").collect()
    assert ids[1] == sorted(r.doc_id for r in kept)
    one = [(r.doc_id, r.text) for r in seen[1].collect()]
    assert ids[2] == sorted(i for i, _, _, k in groups(one, 5) if k)
    two = sorted((r.doc_id, r.text) for r in seen[2].collect())
    _, left = kept_words([t for _, t in two], 35)
    three = sorted((r.doc_id, r.text, r.n_chars) for r in seen[3].collect())
    assert [(i, WORD.findall(t)) for i, t, _ in three] == [(i, w) for (i, _), w in zip(two, left)]
    assert all(len(t) == n for _, t, n in three)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    bad = {i for i, _ in leaks([(i, t) for i, t, _ in three], items)}
    assert ids[4] == sorted(set(ids[3]) - bad)
    texts = {i: t for i, t, _ in three}
    for r in seen[5].collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids)
    assert ids[5] == ids[4]
    assert sorted(r.doc_id for r in C.run(spark, SF001).collect()) == ids[5]


def test_odd_and_empty_documents(spark, odd, tmp_path):
    for name, docs in (("odd", odd[0]), ("empty", spark.createDataFrame([], DOCS))):
        for k, (_, stage) in enumerate(C.STAGES):
            stage(spark, docs, SF001).write.parquet(f"{tmp_path}/{name}{k}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{k}")
        rows = docs.collect()
        assert [r.doc_id for r in rows if r.doc_id is not None] == ([] if name == "empty" else sorted(r.doc_id for r in rows if r.doc_id is not None))
        assert name == "odd" or rows == []


def test_further_columns_with_odd_names(spark, odd, tmp_path):
    names = ["a.b", "_gone", "_quality_kept", "key", "spans", "row", "kid", "`x`"]
    docs = odd[0].selectExpr("*", *[f"concat('{k}-', doc_id) as `{n.replace('`', '``')}`" for k, n in enumerate(names)])
    columns = docs.columns
    for k, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF001)
        assert out.columns[: len(columns)] == columns if k < 4 else set(names) <= set(out.columns)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    rows = docs.collect()
    assert rows and all(r[n] == (None if r.doc_id is None else f"{k}-{r.doc_id}") for r in rows for k, n in enumerate(names))
