"""Operator 1: exact sizes, gapless slots, the law of the communication matrix."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapse.llm import shards
from lapse.llm.queries import QUERIES

from .conftest import DOCS, SF001


def check(rows, n, shards_):
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == n
    assert [sizes[i] for i in range(shards_)] == shards.shard_sizes(n, shards_)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_query_against_rows(spark, documents):
    import zlib

    rows = QUERIES["op1_shards"](spark, SF001).collect()
    check(rows, len(documents[1]), 40)
    texts = {r.doc_id: (r.text or "").encode() for r in documents[1]}
    assert {r.doc_id for r in rows} == set(texts)
    assert all((r.size, r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id]), "rows", None) for r in rows)


@pytest.mark.parametrize("bucket_rows", [200_000, 2])
def test_odd_rows_and_clashing_columns(spark, odd, bucket_rows):
    df = odd[0].withColumnRenamed("lang", "part").withColumnRenamed("source", "slot_").withColumn("_key", odd[0].n_chars)
    out = shards.shuffle_into_shards(df, 4, bucket_rows=bucket_rows)
    assert out.columns == [*df.columns, "shard", "slot"]
    rows = out.collect()
    check(rows, len(odd[1]), 4)
    assert Counter(map(str, (r[: len(df.columns)] for r in rows))) == Counter(map(str, map(tuple, df.collect())))


def test_columns_of_the_result_names_are_replaced(spark):
    df = spark.range(6).selectExpr("id", "'mine' as shard", "id as slot")
    out = shards.shuffle_into_shards(df, 2)
    assert out.columns == ["id", "shard", "slot"]
    check(out.collect(), 6, 2)


def test_empty_and_fewer_rows_than_shards(spark):
    assert shards.shuffle_into_shards(spark.createDataFrame([], DOCS), 4).collect() == []
    check(shards.shuffle_into_shards(spark.range(3), 5).collect(), 3, 5)


def test_same_rows_when_run_again(spark, odd):
    one, two = (sorted(map(str, shards.shuffle_into_shards(odd[0], 3, seed=5).collect())) for _ in range(2))
    assert one == two


def test_hypergeometric_law():
    rng = np.random.default_rng(1)
    got = np.array([shards.hypergeometric(rng, 7, 13, 6) for _ in range(20_000)])
    for k in range(7):
        p = math.comb(7, k) * math.comb(13, 6 - k) / math.comb(20, 6)
        assert abs((got == k).mean() - p) < 0.012
    assert shards.hypergeometric(rng, 0, 5, 3) == 0 and shards.hypergeometric(rng, 5, 0, 3) == 3
    big = [shards.hypergeometric(rng, 10**11, 3 * 10**11, 10**10) for _ in range(200)]
    assert abs(np.mean(big) / 2.5e9 - 1) < 1e-4


def test_matrix_margins_and_uniformity(spark):
    sizes, capacity = [5, 0, 9, 2, 4], [8, 6, 6]
    m = np.array(shards.deal(3, 0, sizes, capacity))
    assert m.sum(1).tolist() == sizes and m.sum(0).tolist() == capacity and (m >= 0).all()
    first = np.mean([shards.deal(s, 0, [10, 10], [10, 10])[0][0] for s in range(3000)])
    assert abs(first - 5) < 0.1


def test_many_partitions_per_block(spark, monkeypatch):
    monkeypatch.setattr(shards, "BLOCKS", 3)
    check(shards.shuffle_into_shards(spark.range(0, 200, 1, 10), 7).collect(), 200, 7)


def test_shuffle_is_uniform_over_shards_and_slots(spark):
    rows = shards.shuffle_into_shards(spark.range(0, 4000, 1, 4), 4, seed=3).collect()
    deal = np.array([[r.id, r.shard, r.slot] for r in rows])
    assert abs(np.corrcoef(deal[:, 0], deal[:, 1])[0, 1]) < 0.06
    assert abs(np.corrcoef(deal[:, 0], deal[:, 2])[0, 1]) < 0.06
    by_part = Counter((int(i) // 1000, int(s)) for i, s, _ in deal)
    assert all(190 <= by_part[p, s] <= 310 for p in range(4) for s in range(4))


@pytest.mark.parametrize("n, of", [(0, 3), (1, 1), (7, 3), (3, 7), (1000, 40), (40, 1000), (5000, 10_000), (100_000, 10_000)])
def test_cells_say_the_same_as_whole_rows_of_the_matrix(n, of):
    rng = np.random.default_rng(n + of)
    counts = np.bincount(rng.integers(0, of, n) ** 2 // of, minlength=of)
    got = shards.cells(3, counts.tolist())
    assert len(got) == shards.stretches(n, of)
    if n:
        places = np.arange(n)
        at = places * len(got) // n
        found = [got["shards"][k][sum(e <= p for e in got["ends"][k])] for p, k in zip(places, at)]
        assert found == np.repeat(np.arange(of), counts).tolist()
        assert max(map(len, got["ends"])) <= -(-n // len(got))


def test_ten_thousand_shards_in_narrow_rows(spark):
    df = spark.range(0, 30_000, numPartitions=4)
    check(shards.shuffle_into_shards(df, 10_000).collect(), 30_000, 10_000)
    parts = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    widest = shards.communication_matrix(parts, 10_000, 7).agg(F.max(F.size("ends")).alias("n")).first().n
    assert widest <= 8


def test_dotted_names(spark):
    df = spark.range(5).selectExpr("id", "id as `a.b`")
    out = shards.shuffle_into_shards(df, 2)
    assert out.columns == ["id", "a.b", "shard", "slot"]
    check(out.collect(), 5, 2)
