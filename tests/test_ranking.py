import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapse.operators.ranking import RankPlan, average_rank_by_value, ordered_running
from lapse.operators.selection import exact_quantiles


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of all rows share one hot score; the rest spread over few levels
        v = 0.5 if i % 3 == 0 else round(rnd.random(), 2)
        rows.append((i, v, rnd.choice(["a", "b"]), rnd.randint(0, 1)))
    return spark.createDataFrame(rows, "k long, v double, g string, y int")


@pytest.mark.parametrize("rows_per_bucket", [10_000_000, 97, 400])
@pytest.mark.parametrize("desc", [True, False])
def test_positions_equal_row_number(spark, rows_per_bucket, desc):
    df = _frame(spark)
    got = ordered_running(df, "v", descending=desc, k="k", sums=["y"],
                          plan=RankPlan(rows_per_bucket=rows_per_bucket))
    o = [F.desc("v") if desc else F.asc("v"), F.asc("k")]
    w = Window.orderBy(*o)
    ref = df.withColumn("ref", F.row_number().over(w)).withColumn(
        "ref_y", F.sum("y").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    j = got.join(ref.select("k", "ref", "ref_y"), "k")
    assert j.count() == 3000
    assert j.filter((F.col("pos") != F.col("ref")) | (F.col("y_cum") != F.col("ref_y"))).count() == 0


def test_hot_value_is_split(spark):
    from lapse.operators import ranking as R

    df = _frame(spark).withColumns({"_proxy": F.col("v"), "_class": F.lit(0)})
    b = R._with_buckets(df, "k", 30)
    sizes = b.groupBy("_b1", "_b2").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("hi"), F.min("v").alias("lo")).collect()
    assert sum(r.lo == r.hi == 0.5 for r in sizes) >= 3  # the value holding a third of the rows spans several buckets
    assert max(r.n for r in sizes) < 1000 / 2


@pytest.mark.parametrize("rows_per_bucket", [10_000_000, 50, 1])
def test_bucket_count_follows_the_rows_and_changes_nothing(spark, rows_per_bucket):
    df = _frame(spark, 1500)
    got = ordered_running(df, "v", k="k", sums=["y"], plan=RankPlan(rows_per_bucket=rows_per_bucket))
    ref = {r.k: i for i, r in enumerate(sorted(df.collect(), key=lambda r: (r.v, r.k)), start=1)}
    assert {r.k: r.pos for r in got.collect()} == ref


@pytest.mark.parametrize("rows_per_bucket", [10_000_000, 10])
@pytest.mark.parametrize("desc", [True, False])
def test_nan_and_null_come_last(spark, rows_per_bucket, desc):
    nan = float("nan")
    rows = [(i, float(i % 40)) for i in range(100)] + [(200 + i, None) for i in range(5)] + [(300 + i, nan) for i in range(5)]
    rows += [(400, float("inf")), (401, float("-inf"))]
    df = spark.createDataFrame(rows, "k long, v double")
    got = {r.k: r.pos for r in ordered_running(df, "v", descending=desc, k="k", plan=RankPlan(rows_per_bucket=rows_per_bucket)).collect()}
    assert [got[300 + i] for i in range(5)] == list(range(103, 108))
    assert [got[200 + i] for i in range(5)] == list(range(108, 113))
    assert (got[400], got[401]) == ((1, 102) if desc else (102, 1))


def test_many_rows_of_a_small_file_are_still_cut(spark, tmp_path):
    """The bucket count comes from counted rows, not from a size estimate."""
    spark.range(200_000).selectExpr("id % 7 as v", "id as k").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = ordered_running(df, "v", k="k", plan=RankPlan(rows_per_bucket=20_000))
    plan = out._jdf.queryExecution().toString()
    assert "_b1" in plan
    assert out.agg(F.max("pos"), F.count_distinct("pos")).first()[:] == (200_000, 200_000)


def test_grouped_positions_restart(spark):
    df = _frame(spark)
    got = ordered_running(df, "v", k="k", group=["g"], plan=RankPlan(rows_per_bucket=150))
    w = Window.partitionBy("g").orderBy("v", "k")
    ref = df.withColumn("ref", F.row_number().over(w))
    j = got.join(ref.select("k", "ref"), "k")
    assert j.filter(F.col("pos") != F.col("ref")).count() == 0


def test_average_rank_with_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 3.0)], "k long, v double")
    got = {r.v: r.avg_rank for r in average_rank_by_value(df, "v").collect()}
    assert got == {5.0: 1.5, 3.0: 3.0}


def test_exact_quantiles_numpy_linear(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (None,)], "x double")
    got = {round(r.q, 2): r.value for r in
           exact_quantiles(df, "x", [0.33, 0.5, 0.67]).collect()}
    assert got[0.5] == pytest.approx(3.0)
    assert got[0.33] == pytest.approx(1.99)
    assert got[0.67] == pytest.approx(4.05)


def test_hash_sample_prefilter_is_exact(spark):
    from lapse.operators.selection import hash_order_key, hash_sample

    df = spark.range(5000).withColumnRenamed("id", "user_key")
    got = [r.user_key for r in hash_sample(df, 37, 42, "user_key").collect()]
    ref = [r.user_key for r in df.withColumn("_h", hash_order_key(42, "user_key"))
           .orderBy("_h", "user_key").limit(37).collect()]
    assert sorted(got) == sorted(ref)  # a sample has no order


@pytest.mark.parametrize("rows_per_bucket", [10_000_000, 5])
def test_null_group_rows_are_kept(spark, rows_per_bucket):
    rows = [(i, None if i % 3 == 0 else "g", float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, g string, v double")
    plan = RankPlan(rows_per_bucket=rows_per_bucket)
    got = ordered_running(df, "v", k="k", group=["g"], plan=plan)
    assert got.count() == 60
    assert got.filter(F.col("g").isNull()).agg(F.max("pos")).first()[0] == 20
    q = exact_quantiles(df, "v", [0.5], group=["g"]).collect()
    assert len(q) == 2


@pytest.mark.parametrize("rows_per_bucket", [10_000_000, 7])
def test_group_totals_come_with_positions(spark, rows_per_bucket):
    rows = [(i, "a" if i % 4 else "b", float(i % 9), i % 3) for i in range(80)]
    df = spark.createDataFrame(rows, "k long, g string, v double, w long")
    got = ordered_running(df, "v", k="k", group=["g"], sums=["w"], totals=True,
                          plan=RankPlan(rows_per_bucket=rows_per_bucket))
    t = {r.g: (r._rows_total, r.w_total) for r in got.select("g", "_rows_total", "w_total").distinct().collect()}
    assert t == {"a": (60, sum(r[3] for r in rows if r[1] == "a")), "b": (20, sum(r[3] for r in rows if r[1] == "b"))}
