"""Quantiles by bracket and count, and selection of k rows, against sorting."""

import contextlib
import hashlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lapse.config import Budget
from lapse.operators import decide as dc
from lapse.operators import selection as sl


@pytest.fixture
def small_accuracy(monkeypatch):
    """Brackets that really cut: 50 instead of 10,000, so groups of a few thousand rows are not kept whole."""
    monkeypatch.setattr(sl, "ACCURACY", 50)


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("shape", ["uniform", "hot", "few", "signed"])
def test_quantiles_equal_numpy(spark, small_accuracy, shape):
    rng = np.random.default_rng(len(shape))
    make = {"uniform": lambda n: rng.random(n), "hot": lambda n: np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n) * 10),
            "few": lambda n: rng.integers(0, 5, n).astype(float), "signed": lambda n: -np.exp(rng.normal(size=n) * 5)}[shape]
    sizes = {"a": 4000, "b": 51, "c": 1, "d": 2, None: 900}
    values = {g: make(n) for g, n in sizes.items()}
    rows = [(g, float(x)) for g, xs in values.items() for x in xs] + [("a", None), ("e", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    qs = [0.0, 0.25, 0.33, 0.5, 0.67, 0.999, 1.0]
    got = {(r.g, r.q): r.value for r in sl.exact_quantiles(df, "x", qs, group=["g"]).collect()}
    want = {(g, q): float(np.quantile(xs, q)) for g, xs in values.items() for q in qs}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12, abs=1e-12) for k in want)
    one = {r.q: r.value for r in sl.exact_quantiles(df.filter("g = 'a'"), "x", qs).collect()}
    assert all(one[q] == pytest.approx(want["a", q], rel=1e-12, abs=1e-12) for q in qs)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert sl.exact_quantiles(df, "x", [0.5]).collect() == []


def test_quantiles_store_nothing_and_move_no_rows(spark, tmp_path):
    """Two scans; what is shuffled are combined counts (an aggregate below each exchange)."""
    spark.range(1000).selectExpr("id % 7 as x", "id % 3 as g").write.parquet(str(tmp_path / "t"))
    plan = plan_of(sl.exact_quantiles(spark.read.parquet(str(tmp_path / "t")), "x", [0.5], group=["g"]))
    assert plan.count("FileScan") == 2 and "lapse-tables" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "Aggregate" in lines[i + 1], line


@pytest.mark.parametrize("k", [1, 37, 999, 4999, 5000, 9000])
def test_hash_sample_is_the_smallest_hashes(spark, k):
    df = spark.range(5000).withColumnRenamed("id", "user_key")
    got = {r.user_key for r in sl.hash_sample(df, k, 42, "user_key").collect()}
    want = sorted(range(5000), key=lambda i: (hashlib.md5(f"42|{i}".encode()).hexdigest(), i))[:k]
    assert got == set(want)


def test_hash_bound_goes_on_within_a_prefix(spark):
    """All hashes share their first 12 digits: the bound needs a fourth histogram."""
    hashes = [f"{'abcdef012345'}{i * 37 % 1000:020x}" for i in range(1000)]
    df = spark.createDataFrame([(h,) for h in hashes], "_h string")
    bound = sl.hash_bound(df, 321)
    assert sum(h[: len(bound)] <= bound for h in hashes) == 321


def test_selection_has_no_ordered_limit(spark):
    df = spark.range(0, 30_000_000, 1, 8).withColumnRenamed("id", "user_key")
    picked = sl.hash_sample(df, 10_000_000, 1, "user_key")
    assert "TakeOrdered" not in plan_of(picked) and "Limit" not in plan_of(picked)
    assert picked.count() == 10_000_000
    top = sl.top_k(df.withColumn("v", F.col("user_key") % 1000), "v", 10_000, "user_key")
    assert "TakeOrdered" not in plan_of(top) and "Limit" not in plan_of(top) and "Sort" not in plan_of(top)


@pytest.mark.parametrize("k", [1, 2, 60, 333, 600, 700, 705, 712, 900])
def test_top_k_equals_sorting(spark, small_accuracy, k):
    nan = float("nan")
    rows = [(i * 31 % 1000, 0.5 if i % 3 == 0 else (i * 7 % 50) / 10) for i in range(700)]
    rows += [(2000 + i, nan) for i in range(7)] + [(3000 - i, None) for i in range(7)]
    df = spark.createDataFrame(rows, "user_key long, v double").repartition(5)
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] is not None and r[1] != r[1], -r[1] if r[1] is not None and r[1] == r[1] else 0, r[0]))
    assert {r.user_key for r in sl.top_k(df, "v", k, "user_key").collect()} == {r[0] for r in order[:k]}


def test_policies_hold_no_ordered_limit(spark):
    ranked = spark.range(500).select(
        F.col("id").alias("user_key"), F.lit(0).alias("is_churn"), (F.col("id") % 13 / 13.0).alias("p_churn"),
        (F.col("id") % 7 * 1.0).alias("e_ltv"), (F.col("id") % 11 * 1.0).alias("priority_score"), (F.col("id") + 1).alias("rank"))
    out = dc.budget_policies(ranked, Budget(budget=5000, voucher=50))
    assert "TakeOrdered" not in plan_of(out)
    assert {r.n_selected for r in out.collect()} == {100}


def test_null_scores_stay_in_the_sensitivity(spark):
    ranked = spark.createDataFrame([(1, 0.5, 2.0, 1), (2, 0.4, None, 2), (3, 0.1, 1.0, 3)], "user_key long, p_churn double, e_ltv double, rank int")
    assert {r.user_key for r in dc.rank_changes(ranked, 3).collect()} == {1, 2, 3}


def test_scatter_sample_size(spark):
    pred = spark.read.parquet(f"{SF001}/customer.parquet").select(
        F.col("c_custkey").alias("user_key"), F.col("c_acctbal").alias("value_true"), F.lit(1.0).alias("value_pred_log"))
    assert dc.value_scatter_sample(pred, k=20).count() == 20
