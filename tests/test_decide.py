import pytest
from pyspark.sql import functions as F

from lapse.config import Budget
from lapse.operators import decide as dc
from lapse.operators.ranking import RankPlan


def _ranked(spark, rows):
    df = spark.createDataFrame([(i + 1, 0, p, e) for i, (p, e) in enumerate(rows)],
                               "user_key long, is_churn int, p_churn double, e_ltv double")
    df = df.withColumn("priority_score", F.col("p_churn") * F.col("e_ltv"))
    from lapse.operators.ranking import ordered_running

    return ordered_running(df, "priority_score", descending=True, k="user_key", pos_col="rank")


def test_sensitivity_swap_because_of_clip(spark):
    ch = {r.user_key: r.rank_change for r in dc.rank_changes(_ranked(spark, [(0.5, 1.85), (0.95, 1.0)]), 2).collect()}
    assert ch == {1: 1.0, 2: 1.0}
    ch2 = {r.user_key: r.rank_change for r in dc.rank_changes(_ranked(spark, [(0.5, 1.85), (0.4, 1.0)]), 2).collect()}
    assert ch2 == {1: 0.0, 2: 0.0}


def test_segments_all_equal_only_medium(spark):
    seg = dc.segment_representatives(_ranked(spark, [(0.3, 10.0)] * 6)).collect()
    assert [r.segment for r in seg] == ["medium-risk,medium-value"]
    assert seg[0].rank == 1


def test_budget_policies_counts_and_uplift(spark):
    rows = [(0.1 * (i % 10), float(i)) for i in range(50)]
    pol = {r.policy: r for r in dc.budget_policies(_ranked(spark, rows), Budget(budget=500, voucher=50)).collect()}
    assert {p.n_selected for p in pol.values()} == {10}
    assert pol["model_priority"].model_uplift_pct == 0.0
    assert pol["model_priority"].expected_revenue >= pol["random"].expected_revenue
    assert pol["model_priority"].expected_revenue >= pol["churn_only"].expected_revenue


@pytest.mark.parametrize("rows_per_bucket", [10_000_000, 3])
def test_priority_rank_is_a_permutation(spark, rows_per_bucket):
    rows = [(0.5, 2.0)] * 10 + [(0.1 * (i % 7), float(i % 5)) for i in range(30)]
    cal = spark.createDataFrame([(i, 0, p, float(e)) for i, (p, e) in enumerate(rows)],
                                "user_key long, is_churn int, p_iso double, value_pred_log double")
    r = dc.priority_scores(cal, plan=RankPlan(rows_per_bucket=rows_per_bucket))
    ranks = sorted(x.rank for x in r.collect())
    assert ranks == list(range(1, 41))


def test_segments_on_empty_input_are_empty(spark):
    empty = _ranked(spark, [(0.3, 1.0)]).limit(0)
    assert dc.segment_representatives(empty).count() == 0
