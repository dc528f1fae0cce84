"""Copies bucketed on the user key: same rows, no exchange, and plain Parquet where a bucket is too large."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lapse.plans.context import Context
from lapse.sources import buckets as bk
from lapse.sources.tables import read_table, table_path


def exchanges(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x]


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("buckets", [2, 8])
def test_base_table_without_exchange(spark, tmp_path, no_broadcast, buckets):
    layouts = bk.bucket_roles(spark, SF001, str(tmp_path), buckets)
    assert {x.buckets for x in layouts.values()} == {buckets}
    plain, stored = Context(spark, SF001).base, Context(spark, str(tmp_path), read=bk.read_bucketed).base
    assert exchanges(plain) and not exchanges(stored)
    assert stored.schema == plain.schema
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))


def test_layout_says_what_is_stored(spark, tmp_path):
    layout = bk.bucket_roles(spark, SF001, str(tmp_path))["orders"]
    orders = read_table(spark, SF001, "orders")
    assert layout.n_rows == orders.count() and layout.key == "o_custkey"
    per = orders.groupBy(F.pmod(F.hash("o_custkey"), F.lit(layout.buckets))).count().agg(F.max("count")).first()[0]
    assert layout.largest == per
    back = bk.read_bucketed(spark, str(tmp_path), "orders")
    assert back.schema == orders.schema and back.exceptAll(orders).count() == 0


def test_hot_user_is_read_as_plain_parquet(spark, tmp_path, no_broadcast):
    """One user holds most rows: its bucket would be one task, so the copy is read without buckets."""
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    path = table_path(str(tmp_path), "hot")
    layout = bk.write_bucketed(df, path, "k", 32)
    assert layout.skew > bk.MAX_SKEW
    out = bk.open_bucketed(spark, path).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert exchanges(out) and out.filter("k = 7").first().n >= 4000
    assert not exchanges(bk.open_bucketed(spark, path, max_skew=1000).groupBy("k").agg(F.count(F.lit(1)).alias("n")))


def test_empty_table_and_null_keys(spark, tmp_path):
    empty = spark.createDataFrame([], "k long, v string")
    assert bk.write_bucketed(empty, str(tmp_path / "e"), "k", 4).n_rows == 0
    assert bk.open_bucketed(spark, str(tmp_path / "e")).count() == 0
    rows = [(None, "a"), (None, "b"), (1, "c")]
    bk.write_bucketed(spark.createDataFrame(rows, "k long, v string"), str(tmp_path / "n"), "k", 4)
    assert sorted(r.v for r in bk.open_bucketed(spark, str(tmp_path / "n")).collect()) == ["a", "b", "c"]


def test_bucket_count():
    assert bk.bucket_count(0) == 1 and bk.bucket_count(1, 6) == 8
    assert bk.bucket_count(30 << 40) == 131_072  # 30 TB in buckets of 256 MB
