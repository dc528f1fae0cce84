"""Learners: invariants where SQL cannot give the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lapse.operators import calibrate as cb
from lapse.operators import learn as lr
from lapse.operators import metrics as me
from lapse.config import CHECKED, Windows
from lapse.sources.sinks import Manifest
from lapse.operators.modeltable import ENC_COLS, SCALED_COLS, UNSCALED_COLS
from lapse.plans.context import Context


@pytest.fixture(scope="module")
def planted(spark):
    """A model table whose label and value follow two of its columns, and its manifest."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1200):
        x = rng.normal(size=len(SCALED_COLS)).tolist()
        codes = [int(rng.integers(0, 3)) for _ in ENC_COLS]
        churn = int(rng.random() < 1 / (1 + np.exp(-(2 * x[0] + codes[0] - 2))))
        value = 3 + 0.5 * x[1] + 0.2 * codes[1] + 0.05 * rng.normal()
        split = "train" if i % 10 < 7 else "val" if i % 10 < 8 else "test"
        rows.append((i, churn, value, float(np.expm1(value)), *codes, *x, *rng.random(len(UNSCALED_COLS)).tolist(), split))
    cols = ["user_key", "is_churn", "log1p_ltv", "ltv", *ENC_COLS, *SCALED_COLS, *UNSCALED_COLS, "split"]
    types = ["long", "int", "double", "double"] + ["int"] * len(ENC_COLS) + ["double"] * (len(SCALED_COLS) + len(UNSCALED_COLS)) + ["string"]
    table = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(cols, types)))
    manifest = Manifest({c: 4 for c in ENC_COLS}, tuple(SCALED_COLS), tuple(UNSCALED_COLS), Windows())
    return lr.Learners(table, manifest)


def metrics(pred):
    return {r.split: r for r in me.model_metrics(pred).collect()}


def test_vectors_have_the_manifest_sizes(planted):
    row = planted.features.first()
    assert row.features.size == 5 * len(ENC_COLS) + len(SCALED_COLS) + len(UNSCALED_COLS)  # each code, plus an invalid one


def test_every_head_beats_a_constant_and_keeps_the_rows(planted):
    churn, value, fm, fmv = planted.churn_scorer(), planted.value_regressor(), planted.interaction_scorer(), planted.interaction_regressor()
    for head in (churn, value, fm, fmv):
        assert head.columns == lr.PRED_COLS and head.count() == 1200 == head.select("user_key").distinct().count()
    assert metrics(churn)["test"].auc_roc > 0.8
    assert metrics(fm)["test"].auc_roc > 0.6
    assert metrics(value)["test"].rmse_log < 0.1
    spread = planted.features.agg(F.stddev_pop("log1p_ltv")).first()[0]
    assert metrics(fmv)["train"].rmse_log < 3 * spread


def test_value_head_is_least_squares(planted):
    """The regressor's training fit against numpy on the same vectors."""
    rows = planted.train.select("features", "log1p_ltv", "user_key").collect()
    x = np.array([r.features.toArray() for r in rows])
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.array([r.log1p_ltv for r in rows])
    fit = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    got = {r.user_key: r.value_pred_log for r in planted.value_regressor().filter("split = 'train'").collect()}
    assert max(abs(got[r.user_key] - f) for r, f in zip(rows, fit)) < 5e-3


def test_joint_heads_join_on_keys(spark, planted):
    churn, value = planted.churn_scorer(), planted.value_regressor()
    j = lr.joint_heads(churn.orderBy(F.desc("user_key")), value.orderBy(F.rand(3)), "j")
    a = {r.user_key: (r.score, r.is_churn) for r in churn.collect()}
    b = {r.user_key: r.value_pred_log for r in value.collect()}
    assert {r.user_key: ((r.score, r.is_churn), r.value_pred_log) for r in j.collect()} == {k: (a[k], b[k]) for k in a}


def test_calibrated_scores_are_monotone(planted):
    pred = planted.joint()
    iso = cb.isotonic_fit(pred.filter("split = 'val'"))
    p = [(r.score, r.p_iso) for r in cb.isotonic_apply(iso, pred.filter("split = 'test'")).collect()]
    p.sort()
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(p, p[1:])) and p[0][1] < p[-1][1]


def test_learned_priority_ranks_every_test_user(spark):
    c = Context(spark, SF001)
    rows = c.learned_ranked.collect()
    test = {r.user_key for r in c.split.filter("split = 'test'").collect()}
    assert {r.user_key for r in rows} == test and sorted(r.rank for r in rows) == list(range(1, len(test) + 1))
    order = sorted(rows, key=lambda r: r.rank)
    assert all(a.priority_score >= b.priority_score for a, b in zip(order, order[1:]))
    assert all(0 <= r.p_churn <= 1 and r.e_ltv == r.e_ltv for r in rows)


def test_decision_keys_can_fail(spark):
    """Policies differ, ranks move and the sample is smaller than its input on the given tables."""
    from conftest import SF01
    from lapse.plans.queries import REGISTRY

    c = Context(spark, SF01, CHECKED)
    revenue = {r.policy: r.expected_revenue for r in REGISTRY["budget_policies"](c).collect()}
    assert len(set(revenue.values())) == 3 and revenue["model_priority"] == max(revenue.values())
    s = REGISTRY["rank_sensitivity"](c).first()
    assert s.n_top == c.p.budget.n_interventions < c.ranked_raw.count() and s.median_rank_change > 0
    assert REGISTRY["value_scatter_sample"](c).count() < c.ranked_raw.count()


@pytest.mark.parametrize("weight, pair", [(1.0, (1, 1)), (1.4395, (3, 2)), (0.3, (2, 7)), (14.6, (15, 1)), (0.01, (1, 100)), (2.5, (5, 2)), (0.0, (1, 1)), (float("inf"), (1, 1))])
def test_replication_is_near_the_weight(weight, pair):
    assert lr.replication(weight) == pair


@pytest.mark.parametrize("share", [0.15, 0.41, 0.75])
def test_weighted_classes_move_the_intercept(spark, share):
    """Unweighted, the intercept of a machine without signal is the log odds; weighted, it is near 0."""
    from pyspark.ml.classification import FMClassifier
    from pyspark.ml.linalg import Vectors

    rows = [(int(i < 1000 * share), Vectors.dense([0.0])) for i in range(1000)]
    df = spark.createDataFrame(rows, ["is_churn", "features"])
    ratio = (1 - share) / share
    fit = lambda d: FMClassifier(featuresCol="features", labelCol="is_churn", factorSize=1, maxIter=300, stepSize=0.1, seed=1).fit(d).intercept
    plain, weighted = fit(df), fit(lr.replicated(df, ratio))
    assert plain == pytest.approx(np.log(share / (1 - share)), abs=0.1)
    assert abs(weighted) < 0.1 < abs(plain)
