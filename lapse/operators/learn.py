"""Learners that fill the prediction table (L1-L3, E8), all MLlib estimators.

* L1 churn scorer: ``LogisticRegression`` with ``weightCol`` = pos_weight on positives.
* L2 value regressor: ``LinearRegression`` on the log1p LTV target.
* L3 pairwise interactions for both heads: ``FMClassifier`` and ``FMRegressor`` (factor size 8).
  MLlib's FM ignores ``weightCol``, so both classes are replicated in a ratio of small integers within
  ``WEIGHT_TOLERANCE`` of the class weight (3 positives to 2 negatives for 1.44).

``Learners`` builds the feature vectors once, with the categorical sizes and the numeric columns of the
feature manifest (a table that lacks one of them is refused), and trains every head on ``split = 'train'``.  Each head returns a prediction table for every split
in the shared schema; ``joint_heads`` joins a churn and a value head on (split, user_key), so
calibration and decisions consume learned scores unchanged.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import FMClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import FMRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.functions.scalar import r6
from lapse.sources.sinks import Manifest
from lapse.sources.store import materialize

FM_FACTOR_SIZE = 8
LOGISTIC_ITERATIONS = 30
FM_ITERATIONS = 20
WEIGHT_TOLERANCE = 0.05
PRED_COLS = ["model_id", "split", "user_key", "is_churn", "score", "value_pred_log", "value_true", "value_true_log"]


def replication(weight: float, tolerance: float = WEIGHT_TOLERANCE) -> tuple[int, int]:
    """(times a positive row, times a negative row): the smallest integers whose ratio is within ``tolerance`` of
    ``weight`` (at most ten copies of the class that weighs less)."""
    if not 0 < weight < float("inf"):
        return 1, 1
    for few in range(1, 11):
        many = max(1, round(few * max(weight, 1 / weight)))
        pair = (many, few) if weight >= 1 else (few, many)
        if abs(pair[0] / pair[1] / weight - 1) <= tolerance:
            break
    return pair


def replicated(train: DataFrame, weight: float, label: str = "is_churn") -> DataFrame:
    """``train`` with both classes repeated in the ratio of their weights."""
    pos, neg = replication(weight)
    times = F.when(F.col(label) == 1, pos).otherwise(neg)
    return train.withColumn("_rep", F.explode(F.array_repeat(F.lit(1), times))).drop("_rep")


def vectorised(model_table: DataFrame, manifest: Manifest) -> DataFrame:
    """One-hot categorical codes plus scaled and unscaled numerics in one vector column
    ``features``.  The size of each code is the manifest's cardinality, given to the encoder as
    column metadata: no pass over the data learns it again."""
    sizes = manifest.require(model_table).cardinality
    nominal = lambda n: {"ml_attr": {"type": "nominal", "num_vals": n}}
    coded = model_table.withColumns({f"{c}_n": F.col(c).cast("double").alias(f"{c}_n", metadata=nominal(n)) for c, n in sizes.items()})
    for c, n in sizes.items():
        coded = coded.withMetadata(f"{c}_n", nominal(n))
    onehot = OneHotEncoder(inputCols=[f"{c}_n" for c in sizes], outputCols=[f"{c}_oh" for c in sizes], dropLast=False, handleInvalid="keep")
    asm = VectorAssembler(inputCols=[f"{c}_oh" for c in sizes] + [*manifest.scaled, *manifest.unscaled], outputCol="features")
    out = Pipeline(stages=[onehot, asm]).fit(coded).transform(coded)
    return out.select("split", "user_key", "is_churn", "ltv", "log1p_ltv", "features")


def _out(pred: DataFrame, model_id: str, score, value) -> DataFrame:
    return pred.select(
        F.lit(model_id).alias("model_id"), "split", "user_key", "is_churn", score.alias("score"),
        value.alias("value_pred_log"), F.col("ltv").alias("value_true"), F.col("log1p_ltv").alias("value_true_log"),
    )


class Learners:
    """Heads over one stored feature frame."""

    def __init__(self, model_table: DataFrame, manifest: Manifest, seed: int = 42):
        self.model_table, self.manifest, self.seed = model_table, manifest, seed

    @cached_property
    def features(self) -> DataFrame:
        return materialize(vectorised(self.model_table, self.manifest), "learner_features", "split")

    @cached_property
    def train(self) -> DataFrame:
        return self.features.filter(F.col("split") == "train")

    @cached_property
    def pos_weight(self) -> float:
        n = self.train.agg(F.count_if(F.col("is_churn") == 0).alias("n0"), F.count_if(F.col("is_churn") == 1).alias("n1")).first()
        return n.n0 / n.n1 if n.n1 else 1.0

    def churn_scorer(self, model_id: str = "mllib_logistic") -> DataFrame:
        """L1: class-weighted logistic regression; score = P(churn), no value head."""
        w = self.train.withColumn("_w", F.when(F.col("is_churn") == 1, F.lit(self.pos_weight)).otherwise(F.lit(1.0)))
        lr = LogisticRegression(featuresCol="features", labelCol="is_churn", weightCol="_w", maxIter=LOGISTIC_ITERATIONS, regParam=1e-4)
        return _out(lr.fit(w).transform(self.features), model_id, r6(vector_to_array("probability")[1]), F.lit(None).cast("double"))

    def value_regressor(self, model_id: str = "mllib_linear") -> DataFrame:
        """L2: linear regression of log1p(LTV); the value head, no churn head (score 0.5)."""
        lin = LinearRegression(featuresCol="features", labelCol="log1p_ltv", regParam=1e-4, solver="normal")
        return _out(lin.fit(self.train).transform(self.features), model_id, F.lit(0.5), r6(F.col("prediction")))

    def interaction_scorer(self, model_id: str = "mllib_fm") -> DataFrame:
        """L3: factorisation machine (k = 8) with both classes replicated in the ratio of their weights."""
        train = replicated(self.train, self.pos_weight)
        fm = FMClassifier(featuresCol="features", labelCol="is_churn", factorSize=FM_FACTOR_SIZE, maxIter=FM_ITERATIONS, seed=self.seed, stepSize=0.05)
        return _out(fm.fit(train).transform(self.features), model_id, r6(vector_to_array("probability")[1]), F.lit(None).cast("double"))

    def interaction_regressor(self, model_id: str = "mllib_fm_value") -> DataFrame:
        """L3, value head: factorisation machine (k = 8) on log1p(LTV)."""
        fm = FMRegressor(featuresCol="features", labelCol="log1p_ltv", factorSize=FM_FACTOR_SIZE, maxIter=FM_ITERATIONS, seed=self.seed, stepSize=0.05)
        return _out(fm.fit(self.train).transform(self.features), model_id, F.lit(0.5), r6(F.col("prediction")))

    def joint(self, model_id: str = "learned_joint") -> DataFrame:
        return joint_heads(self.churn_scorer(), self.value_regressor(), model_id)


def joint_heads(churn: DataFrame, value: DataFrame, model_id: str) -> DataFrame:
    """One model of two heads, joined on (split, user_key); truth columns are the churn head's."""
    v = value.select(F.col("split").alias("_s"), F.col("user_key").alias("_u"), F.col("value_pred_log").alias("_v"))
    j = churn.join(v, (F.col("split") == F.col("_s")) & (F.col("user_key") == F.col("_u")), "inner")
    return j.select(
        F.lit(model_id).alias("model_id"), "split", "user_key", "is_churn", "score", F.col("_v").alias("value_pred_log"), "value_true", "value_true_log")


def all_heads(learners: Learners) -> DataFrame:
    """Prediction table of the four single heads and the joined model."""
    heads = [learners.churn_scorer(), learners.value_regressor(), learners.interaction_scorer(), learners.interaction_regressor()]
    return reduce(DataFrame.unionByName, [*heads, joint_heads(heads[0], heads[1], "learned_joint")])
