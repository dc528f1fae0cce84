"""Probability calibration fitted on validation, applied to test (M7, M8).

Isotonic (M8): validation rows are reduced to one weighted point per distinct score, at the
score's own resolution, by a map-side combined aggregate.  MLlib pools the points inside every
partition before the driver merges what is left - the steps of the fitted function, which the model
holds on the driver anyway.  The fitted model transforms test rows JVM-side: knots map to their value,
scores between knots interpolate linearly, scores outside clamp.

Temperature (M7): one coefficient ``c`` of a no-intercept, unregularised logistic
regression on the logit ``z``; ``T = 1 / c`` and the calibrated probability is
``sigmoid(z / T)``.  Scores of exactly 0 or 1 have no logit; they are taken as ``LOGIT_EPS`` away
from the end, in the fit and in its use, so no row is lost.  Rows are first reduced to (distinct logit, label, count), so the
optimiser's passes are over a table bounded by the score resolution.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.functions.scalar import logistic, r6

LOGIT_EPS = 1e-7


def isotonic_fit(val: DataFrame, score: str = "score", label: str = "is_churn") -> IsotonicRegressionModel:
    pts = val.filter(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("_x")).agg(
        F.avg(F.col(label).cast("double")).alias("_y"), F.count(F.lit(1)).cast("double").alias("_w")
    )
    iso = IsotonicRegression(featuresCol="_x", labelCol="_y", weightCol="_w", predictionCol="_p", isotonic=True)
    return iso.fit(pts)


def isotonic_apply(model: IsotonicRegressionModel, df: DataFrame, score: str = "score", out: str = "p_iso") -> DataFrame:
    """A null score has a null probability."""
    x = df.withColumn("_x", F.coalesce(F.col(score).cast("double"), F.lit(0.0)))
    p = F.when(F.col(score).isNotNull(), r6(F.col("_p")))
    return model.transform(x).withColumn(out, p).drop("_x", "_p")


def logit(p) -> F.Column:
    """ln(p / (1 - p)) of p moved into [LOGIT_EPS, 1 - LOGIT_EPS]; null stays null."""
    c = F.col(p) if isinstance(p, str) else p
    inside = F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(1.0 - LOGIT_EPS)), F.lit(LOGIT_EPS)))
    return F.ln(inside / (F.lit(1.0) - inside))


def temperature_fit(val: DataFrame, score: str = "score", label: str = "is_churn") -> float:
    """Temperature T > 0 minimising the validation log loss of sigmoid(z / T).

    The coefficient c = 1 / T is fitted with a lower bound of 0 (bounded L-BFGS-B).  When
    the logits carry no or inverse signal the optimum sits on the bound: c = 0, T = inf,
    and every calibrated probability is 0.5.
    """
    from pyspark.ml.linalg import Matrices

    # One row per (distinct logit, label) weighted by its count: the weighted log loss
    # equals the per-row one, so the optimum is the same while every optimiser pass
    # touches at most 2 x (distinct scores) rows instead of the whole validation split.
    z = (
        val.select(logit(score).alias("z"), F.col(label).cast("double").alias("y"))
        .filter(F.col("z").isNotNull() & ~F.isnan("z"))
        .groupBy("z", "y").agg(F.count(F.lit(1)).cast("double").alias("w"))
    )
    vec = VectorAssembler(inputCols=["z"], outputCol="features").transform(z)
    lr = LogisticRegression(featuresCol="features", labelCol="y", weightCol="w", fitIntercept=False,
                            standardization=False, regParam=0.0, maxIter=100, tol=1e-10,
                            lowerBoundsOnCoefficients=Matrices.dense(1, 1, [0.0]))
    coef = float(lr.fit(vec).coefficients[0])
    return float("inf") if coef <= 0 else 1.0 / coef


def rounded(temperature: float) -> float:
    """The temperature at four significant digits, below which two optimisers may differ."""
    return temperature if temperature == float("inf") else float(f"{temperature:.4g}")


def temperature_apply(df: DataFrame, temperature: float, score: str = "score", out: str = "p_temp") -> DataFrame:
    if temperature == float("inf"):
        return df.withColumn(out, F.lit(0.5))
    return df.withColumn(out, r6(logistic(logit(score) / F.lit(temperature))))
