"""Split, imputation, encoding, scaling: the model table.

Fitted state (medians, category codes, means / stds) is learned on ``split = 'train'``
only and kept as small DataFrames; applying it never moves user rows to the driver.
The state that is inlined as literals (4 medians, 7 means and 7 stds) is a fixed number
of scalars; category maps are joined, broadcast only where Spark measures them small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.config import Windows
from lapse.functions.scalar import r6, standardise
from lapse.operators.ranking import DEFAULT_PLAN, RankPlan, ordered_running
from lapse.operators.selection import exact_quantiles, hash_order_key
from lapse.sources.store import materialize

# ---- fixed values: feature groups of the model table ------------------------------------
CATEGORICAL = ["city", "gender", "registered_via", "payment_method_id"]
EMBEDDING_DIMS = {"city": 5, "gender": 2, "registered_via": 3, "payment_method_id": 8}
IMPUTE_COLS = ["bd_clean", "registration_tenure_days", "avg_payment_plan_days", "avg_actual_amount_paid"]
SCALE_COLS = [
    "bd_clean", "registration_tenure_days", "avg_payment_plan_days", "avg_actual_amount_paid",
    "num_transactions", "total_secs_log", "daily_active_days",
]
UNSCALED_COLS = ["is_auto_renew_rate", "avg_song_completion"]
TARGET_COLS = ["user_key", "is_churn", "log1p_ltv", "ltv"]
# -------------------------------------------------------------------------------------------

ENC_COLS = [f"{c}_enc" for c in CATEGORICAL]
SCALED_COLS = [f"{c}_scaled" for c in SCALE_COLS]
MODEL_COLS = TARGET_COLS + ENC_COLS + SCALED_COLS + UNSCALED_COLS


def stratified_split(df: DataFrame, *, key: str = "user_key", stratum: str = "is_churn", seed: int = 42,
                     holdout_pct: int = 30, test_pct_of_holdout: int = 50,
                     plan: RankPlan = DEFAULT_PLAN) -> DataFrame:
    """Disjoint, exhaustive train / val / test split, stratified, with exact counts.

    Inside each stratum rows are ordered by md5(seed|key) (ties on the key); with n rows
    the hold-out is ceil(n * holdout_pct / 100) rows, of which ceil(h * test_pct / 100)
    are test.  Integer arithmetic only, so any engine gets the same membership.
    Strata sizes are one row per stratum value (the label domain), joined by broadcast.
    """
    h = hash_order_key(seed, key)
    d = df.select(key, stratum, h.alias("_h")).withColumn(
        "_h60", F.conv(F.substring("_h", 1, 15), 16, 10).cast("long")
    )
    r = ordered_running(d, "_h60", tiebreak=["_h", key], group=[stratum], pos_col="_pos", totals=True, plan=plan)
    r = r.withColumnRenamed("_rows_total", "_n")
    n_hold = F.expr(f"(_n * {holdout_pct} + 99) div 100")
    n_test = F.expr(f"((_n * {holdout_pct} + 99) div 100 * {test_pct_of_holdout} + 99) div 100")
    n_train = F.col("_n") - n_hold
    n_val = n_hold - n_test
    split = (
        F.when(F.col("_pos") <= n_train, F.lit("train"))
        .when(F.col("_pos") <= n_train + n_val, F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return r.select(key, stratum, split.alias("split"))


def attach_split(features: DataFrame, split: DataFrame, key: str = "user_key") -> DataFrame:
    return features.join(split.select(key, "split"), key, "inner")


# ---- E4: median imputation -----------------------------------------------------------------
def fit_medians(train: DataFrame, cols=IMPUTE_COLS) -> DataFrame:
    """Exact medians (null-skipping midpoint) of ``cols``.

    Columns are unpivoted to (feature, value), so the two passes of the bracket serve every feature.
    """
    long = train.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "value"
    )
    q = exact_quantiles(long, "value", [0.5], group=["feature"])
    return q.select("feature", F.col("value").alias("median"))


def apply_medians(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in medians.items()})


# ---- E5 / J6: label encoding ----------------------------------------------------------------
def fit_category_map(train: DataFrame, cols=CATEGORICAL, plan: RankPlan = DEFAULT_PLAN) -> DataFrame:
    """Codes 0..n-1 in the column's own type order (numbers numerically), per feature.

    Returns (feature, value, code, cardinality) with ``value`` as string; the extra
    unknown code equals ``cardinality - 1``.  All features share one ordered pass:
    rows are (feature, value, numeric sort key) and positions restart per feature;
    string values sort by a monotone byte-prefix key, then by the value itself.
    """
    items = []
    for c in cols:
        kind = train.schema[c].dataType
        if isinstance(kind, T.StringType):
            sort_key = F.conv(F.rpad(F.substring(F.hex(F.col(c)), 1, 14), 14, "0"), 16, 10)
        else:
            sort_key = F.col(c)
        # 20 integer digits hold every BIGINT code apart, 18 fractional ones any decimal code
        items.append(F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"), sort_key.cast("decimal(38,18)").alias("_sk")))
    long = (
        train.select(F.explode(F.array(*items)).alias("_i")).select("_i.*")
        .filter(F.col("value").isNotNull()).distinct()
    )
    r = ordered_running(long, "_sk", tiebreak=["value"], group=["feature"], pos_col="_pos", totals=True, plan=plan)
    return r.select(
        "feature", "value", (F.col("_pos") - 1).cast("int").alias("code"),
        (F.col("_rows_total") + 1).cast("int").alias("cardinality"),
    )


def apply_category_map(df: DataFrame, cmap: DataFrame, cols=CATEGORICAL) -> DataFrame:
    """Left join each feature's codes; unseen values and nulls get the unknown code.

    The fitted map is stored once and read back per feature, so each join is planned from its
    measured size: Spark broadcasts the small maps and shuffles for the others.  Only the
    cardinalities, one number per feature, come to the driver.
    """
    cmap = materialize(cmap.select("feature", "value", "code", "cardinality"), "category_map", "feature")
    sizes = {r["feature"]: r["n"] for r in cmap.groupBy("feature").agg(F.max("cardinality").alias("n")).collect()}
    out = df
    for c in cols:
        m = cmap.filter(F.col("feature") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_code_{c}")
        )
        unknown = sizes.get(c, 1) - 1
        out = (
            out.join(m, F.col(c).cast("string") == F.col(f"_v_{c}"), "left")
            .withColumn(f"{c}_enc", F.coalesce(F.col(f"_code_{c}"), F.lit(unknown)).cast("int"))
            .drop(f"_v_{c}", f"_code_{c}")
        )
    return out


# ---- E6: scaling ----------------------------------------------------------------------------
def fit_scaler(train: DataFrame, cols=SCALE_COLS) -> DataFrame:
    """Mean and population std per column (one aggregate), long form (feature, mean, std)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}__mean"), F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std")]
    wide = train.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
        for c in cols
    ])).alias("s")).select("s.*")


def apply_scaler(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({
        f"{c}_scaled": r6(standardise(F.col(c), F.lit(m), F.lit(s))) for c, (m, s) in stats.items()
    })


# ---- A15 / A16 / S9 ------------------------------------------------------------------------
def class_weight(train: DataFrame, label: str = "is_churn") -> DataFrame:
    """Class counts and pos_weight = N0 / N1 (null when there is no positive)."""
    a = train.agg(F.count_if(F.col(label) == 0).alias("n_neg"), F.count_if(F.col(label) == 1).alias("n_pos"))
    return a.withColumn("pos_weight", r6(F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos").cast("double"))))


def split_profile(model_table: DataFrame) -> DataFrame:
    """Per split rows, churn rate, exact LTV median and null cells (every split)."""
    cols = [c for c in MODEL_COLS if c != "user_key"]
    nulls = None
    for c in cols:
        t = F.count_if(F.col(c).isNull())
        nulls = t if nulls is None else nulls + t
    base = model_table.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("is_churn")).alias("churn_rate"), nulls.alias("null_cells")
    )
    med = exact_quantiles(model_table, "ltv", [0.5], group=["split"]).select(
        "split", r6(F.col("value")).alias("ltv_median")
    )
    return base.join(med, "split", "left")


def feature_manifest(cmap: DataFrame) -> DataFrame:
    """One row per categorical feature: encoded column, cardinality, embedding dim, unknown index."""
    dims = F.create_map(*[x for c, d in EMBEDDING_DIMS.items() for x in (F.lit(c), F.lit(d))])
    return cmap.select("feature", "cardinality").distinct().select(
        "feature",
        F.concat(F.col("feature"), F.lit("_enc")).alias("column"),
        "cardinality",
        dims[F.col("feature")].alias("embedding_dim"),
        (F.col("cardinality") - 1).alias("unknown_index"),
    )


def full_manifest(cmap: DataFrame, w: Windows) -> DataFrame:
    """The manifest with the time windows and numeric columns that training obeys."""
    day = lambda d: F.lit(d).cast("date")
    return feature_manifest(cmap).withColumns({
        "feature_cutoff": day(w.feature_cutoff),
        "value_window": F.array(day(w.value_start), day(w.value_end)),
        "engagement_window": F.array(day(w.engagement_start), day(w.engagement_end)),
        "numerical_scaled": F.array(*[F.lit(x) for x in SCALED_COLS]),
        "numerical_unscaled": F.array(*[F.lit(x) for x in UNSCALED_COLS]),
    })


class ModelTableBuilder:
    """Fits imputation, encoding and scaling on train and applies them to every split."""

    def __init__(self, split_features: DataFrame, plan: RankPlan = DEFAULT_PLAN):
        self.df = split_features
        self.plan = plan
        self.train = split_features.filter(F.col("split") == "train")

    def medians(self) -> DataFrame:
        return fit_medians(self.train)

    def imputed(self) -> DataFrame:
        vals = {r["feature"]: r["median"] for r in self.medians().collect()}  # 4 scalars
        return apply_medians(self.df, {c: vals[c] for c in IMPUTE_COLS})

    def category_map(self) -> DataFrame:
        return fit_category_map(self.train, plan=self.plan)

    def encoded(self, imputed: DataFrame | None = None) -> DataFrame:
        return apply_category_map(self.imputed() if imputed is None else imputed, self.category_map())

    def scaler(self, imputed: DataFrame) -> DataFrame:
        return fit_scaler(imputed.filter(F.col("split") == "train"))

    def model_table(self) -> DataFrame:
        imp = self.imputed()
        stats = {r["feature"]: (r["mean"], r["std"]) for r in self.scaler(imp).collect()}  # 7 x 2 scalars
        enc = self.encoded(imp)
        return apply_scaler(enc, stats).select(*MODEL_COLS, "split")
