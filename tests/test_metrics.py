import pytest
from pyspark.sql import functions as F

from lapse.operators import metrics as me
from lapse.operators.ranking import RankPlan

SIX = [(0.9, 1), (0.8, 0), (0.8, 1), (0.4, 0), (0.3, 1), (0.1, 0)]


def _pred(spark, rows, model="m", split="test"):
    return spark.createDataFrame(
        [(model, split, i, y, float(s)) for i, (s, y) in enumerate(rows)],
        "model_id string, split string, user_key long, is_churn int, score double",
    )


@pytest.mark.parametrize("rows_per_bucket", [10_000_000, 1])
def test_auc_and_average_precision_fixture(spark, rows_per_bucket):
    curve = me.score_curve(_pred(spark, SIX), plan=RankPlan(rows_per_bucket=rows_per_bucket))
    r = me.ranking_metrics(curve).first()
    assert r.auc_roc == pytest.approx(0.7222222, abs=1e-6)
    assert r.average_precision == pytest.approx(0.7555556, abs=1e-6)


def test_constant_score_identities(spark):
    rows = [(0.5, y) for y in [1, 0, 0, 1, 0, 0, 0, 1]]
    r = me.ranking_metrics(me.score_curve(_pred(spark, rows))).first()
    assert r.auc_roc == 0.5
    assert r.average_precision == pytest.approx(3 / 8)


def test_single_class_gives_null(spark):
    r = me.ranking_metrics(me.score_curve(_pred(spark, [(0.2, 0), (0.7, 0)]))).first()
    assert r.auc_roc is None and r.average_precision is None


def test_roc_and_pr_points_have_start_and_end(spark):
    curve = me.score_curve(_pred(spark, SIX))
    roc = me.roc_points(curve).collect()
    pr = me.pr_points(curve).collect()
    assert len(roc) == 5 + 1 and len(pr) == 5 + 1
    assert any(r.threshold == float("inf") and r.fpr == 0 and r.tpr == 0 for r in roc)
    assert any(r.threshold is None and r.recall == 0 and r.precision == 1 for r in pr)
    last = max(roc, key=lambda r: (r.fpr, r.tpr))
    assert (last.fpr, last.tpr) == (1.0, 1.0)


def test_bins_use_linspace_edges_and_keep_empty_bins(spark):
    rows = [(p, 0) for p in [0.0, 0.1, 0.3, 0.6, 0.7, 1.0]]
    df = _pred(spark, rows)
    got = [r.bin for r in df.select(me.bin_index(F.col("score"), 10).alias("bin")).collect()]
    assert got == [0, 1, 2, 5, 6, 9]
    bins = me.reliability_bins(df, 10).orderBy("bin").collect()
    assert len(bins) == 10 and bins[3].n == 0 and bins[3].avg_conf is None


def test_ece_counts_out_of_range_in_n(spark):
    df = _pred(spark, [(0.95, 1), (1.2, 1), (0.05, 0), (-0.1, 0)])
    r = me.expected_calibration_error(df, 10).first()
    assert r.n == 4
    assert r.ece == pytest.approx((1 * 0.05 + 1 * 0.05) / 4, abs=1e-6)
