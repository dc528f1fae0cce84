"""Prediction table from closed-form scorers over the feature table.

The prediction table is the hand-off point between learners and the decision layer:
``(model_id, split, user_key, is_churn, score, value_pred_log, value_true, value_true_log)``.
The closed-form scorers below are deterministic functions of base-table columns, so
the metric, calibration and decision operators can be checked against SQL; MLlib
learners (``lapse.operators.learn``) emit the same schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.functions.scalar import ln1p, logistic, round_half_up

# ---- fixed values: closed-form scorers ------------------------------------------------------
# model_id -> churn logit (a, b, c): a - b * num_transactions + c * (user_key % 50), or None
#          -> value log  (a, b): (a + b * (user_key % 8)) * ln(1 + avg_actual_amount_paid), or None
# A missing churn head scores a constant 0.5; a missing value head predicts null.
SCORERS = {
    "churn_only": ((5.0, 0.45, 0.06), None),
    "value_only": (None, (0.2, 0.1)),
    "joint": ((5.0, 0.45, 0.06), (0.2, 0.1)),
    "joint_alt": ((4.5, 0.40, 0.05), (0.25, 0.08)),
}
CHURN_CEILING_MODEL = "churn_only"
VALUE_CEILING_MODEL = "value_only"
SCORE_DECIMALS = 4
# -----------------------------------------------------------------------------------------------


def _churn_score(coef) -> Column:
    if coef is None:
        return F.lit(0.5)
    a, b, c = coef
    z = F.lit(a) - F.lit(b) * F.col("num_transactions") + F.lit(c) * (F.col("user_key") % 50)
    return round_half_up(logistic(z), SCORE_DECIMALS)


def _value_pred(coef) -> Column:
    if coef is None:
        return F.lit(None).cast("double")
    a, b = coef
    w = F.lit(a) + F.lit(b) * (F.col("user_key") % 8)
    return round_half_up(w * ln1p(F.coalesce(F.col("avg_actual_amount_paid"), F.lit(0.0))), SCORE_DECIMALS)


def closed_form_predictions(split_features: DataFrame, scorers=SCORERS) -> DataFrame:
    """One scan of the feature table, one output row per (model, user): a Generate over an
    array of per-model structs instead of a union of per-model scans."""
    models = F.array(*[
        F.struct(F.lit(mid).alias("model_id"), _churn_score(ch).alias("score"), _value_pred(va).alias("value_pred_log"))
        for mid, (ch, va) in scorers.items()
    ])
    return split_features.select(
        "split", "user_key", "is_churn", F.col("ltv").alias("value_true"),
        F.col("log1p_ltv").alias("value_true_log"), F.explode(models).alias("_m"),
    ).select("_m.model_id", "split", "user_key", "is_churn", "_m.score", "_m.value_pred_log", "value_true",
             "value_true_log")
