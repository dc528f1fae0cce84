import random

import pytest
from pyspark.sql import functions as F

from lapse.llm import scans


@pytest.mark.parametrize("n, base", [(1, 4), (2, 1), (700, 8), (3000, 5000)])
def test_list_ranks(spark, n, base):
    ids = list(range(n))
    random.Random(n).shuffle(ids)
    rows = [(x, ids[k - 1] if k else None, ids[k + 1] if k + 1 < n else None) for k, x in enumerate(ids)]
    out = scans.list_ranks(spark.createDataFrame(rows, "id long, prv long, nxt long"), base=max(base, 2))
    assert sorted((r.place, r.id) for r in out.collect()) == list(enumerate(ids))


def test_list_ranks_of_nothing(spark):
    assert scans.list_ranks(spark.createDataFrame([], "id long, prv long, nxt long")).collect() == []


def test_global_order_splits_a_hot_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("x"))
    out = scans.global_order(df, [F.asc("k"), F.desc("x")], "test-order")
    want = sorted(((7 if i % 3 == 0 else i % 50), -i) for i in range(5000))
    assert [(r.k, -r.x) for r in sorted(out.collect(), key=lambda r: r.g)] == want
    assert sorted(r.g for r in out.collect()) == list(range(5000))


def test_prefix_over_buckets(spark):
    df = spark.range(1000).select(F.col("id").alias("at"), (F.col("id") * 7 % 11).alias("v"), F.when(F.col("id") % 100 == 5, F.col("id")).alias("m"))
    out = {r["at"]: r for r in scans.prefix(df, "at", {"s": ("sum", "v"), "x": ("bit_xor", "v"), "last": ("max", "m")}, bucket=64).collect()}
    s = x = 0
    last = None
    for i in range(1000):
        s, x, last = s + i * 7 % 11, x ^ (i * 7 % 11), i if i % 100 == 5 else last
        assert (out[i].s, out[i].x, out[i]["last"]) == (s, x, last)
