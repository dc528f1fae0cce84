"""Business decision layer over calibrated scores.

Scale notes: the ranking is the bucketed global position (no single-partition sort);
the n = budget // voucher picks of a policy are filters by a rank or a threshold; segment
thresholds are exact quantiles of one bracket; representatives come from two hash aggregates (min distance,
then min rank) instead of a per-segment sort; rank sensitivity unpivots the two perturbed scores
and ranks their distinct values once, restarting per perturbation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.config import Budget
from lapse.functions.scalar import clip, exp_m1, r6
from lapse.operators.explore import equal_width_histogram
from lapse.operators.ranking import DEFAULT_PLAN, RankPlan, average_rank_by_value, join_null_safe, ordered_running
from lapse.operators.selection import exact_quantiles, hash_sample, top_k

# ---- fixed values: risk x value segments listed in the report, with their action ------------
SEGMENT_ACTIONS = [
    ("high", "high", "Immediate: personal outreach + premium discount"),
    ("high", "low", "Low priority: automated email only"),
    ("low", "high", "Monitor: no action right now"),
    ("medium", "medium", "Queue for weekly retention campaign"),
    ("low", "low", "No action: below cost-of-retention threshold"),
]
SEGMENT_QUANTILES = (0.33, 0.67)
# -----------------------------------------------------------------------------------------------


def priority_scores(cal: DataFrame, prob: str = "p_iso", plan: RankPlan = DEFAULT_PLAN) -> DataFrame:
    """B1 + J7 + F5 + W2: P(churn) x E[LTV] per user, ranked 1..n (ties on user_key).

    ``cal`` is keyed by user (joined on keys, never by position).
    """
    s = cal.select(
        "user_key", "is_churn", F.col(prob).alias("p_churn"), r6(exp_m1(F.col("value_pred_log"))).alias("e_ltv")
    ).withColumn("priority_score", F.col("p_churn") * F.col("e_ltv"))
    r = ordered_running(s, "priority_score", descending=True, k="user_key", pos_col="rank", plan=plan)
    return r.select("user_key", "is_churn", "p_churn", "e_ltv", "priority_score", "rank")


def _thresholds(df: DataFrame, cols: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """The segment quantiles of every column, from the same two passes; (None, None) when it has no values."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "feature", "x")
    got = {(r.feature, r.q): r.value for r in exact_quantiles(long, "x", SEGMENT_QUANTILES, group=["feature"]).collect()}
    return {c: tuple(r6_py(got.get((c, q))) for q in SEGMENT_QUANTILES) for c in cols}


def r6_py(x: float | None) -> float | None:
    """Python twin of ``r6`` for fitted scalars inlined as literals."""
    import math

    if x is None or not abs(x) < 2.0 ** 53 / 1e6:
        return x
    return math.floor(x * 1e6 + 0.5) / 1e6


def _level(col: str, lo: float | None, hi: float | None) -> F.Column:
    if lo is None or hi is None:
        return F.lit(None).cast("string")
    c = F.col(col)
    return F.when(c < F.lit(lo), "low").when(c > F.lit(hi), "high").when(c.between(lo, hi), "medium")


def segment_representatives(ranked: DataFrame) -> DataFrame:
    """B2: for each listed (risk, value) pair, the user whose priority is closest to the
    segment's median priority (ties: best rank).  Empty segments are skipped.

    Risk / value levels: below the .33 quantile, above the .67 quantile, or between
    (inclusive).  Thresholds are 4 fitted scalars.
    """
    cut = _thresholds(ranked, ["p_churn", "e_ltv"])
    seg = ranked.withColumns({"risk": _level("p_churn", *cut["p_churn"]), "value": _level("e_ltv", *cut["e_ltv"])})
    spark = ranked.sparkSession
    actions = spark.createDataFrame(SEGMENT_ACTIONS, "risk string, value string, action string")
    listed = seg.join(F.broadcast(actions), ["risk", "value"], "inner")  # 5-row table
    med = exact_quantiles(listed.withColumn("_seg", F.concat_ws(",", "risk", "value")), "priority_score", [0.5],
                          group=["_seg"]).select("_seg", r6(F.col("value")).alias("_median"))
    d = listed.withColumn("_seg", F.concat_ws(",", "risk", "value")).join(F.broadcast(med), "_seg", "inner")
    d = d.withColumn("_dist", F.abs(F.col("priority_score") - F.col("_median")))
    best = d.groupBy("_seg").agg(F.min("_dist").alias("_best"))
    cand = d.join(F.broadcast(best), "_seg", "inner").filter(F.col("_dist") == F.col("_best"))
    rep = cand.groupBy("_seg", "risk", "value", "action").agg(
        F.min_by("user_key", F.col("rank")).alias("user_key"),
        F.min_by("p_churn", F.col("rank")).alias("p_churn"),
        F.min_by("e_ltv", F.col("rank")).alias("e_ltv"),
        F.min_by("priority_score", F.col("rank")).alias("priority_score"),
        F.min("rank").alias("rank"),
    )
    return rep.select(
        F.concat(F.col("risk"), F.lit("-risk,"), F.col("value"), F.lit("-value")).alias("segment"),
        "user_key", "rank", "p_churn", "e_ltv", "priority_score", "action",
    )


def budget_policies(ranked: DataFrame, budget: Budget, seed: int = 42) -> DataFrame:
    """Expected revenue saved when the n = budget // voucher vouchers go to the model's
    top-n, a reproducible random n, or the n highest churn probabilities; and the model's
    gain over each policy in percent (``model_uplift_pct``)."""
    n = budget.n_interventions
    model = ranked.filter(F.col("rank") <= n).withColumn("policy", F.lit("model_priority"))
    rand = hash_sample(ranked, n, seed, "user_key").withColumn("policy", F.lit("random"))
    churn = top_k(ranked, "p_churn", n, "user_key").withColumn("policy", F.lit("churn_only"))
    picked = model.unionByName(rand).unionByName(churn)
    rev = picked.groupBy("policy").agg(
        F.count(F.lit(1)).alias("n_selected"),
        r6(F.sum(F.col("priority_score") * F.lit(budget.success_rate))).alias("expected_revenue"),
    )
    model_rev = rev.filter(F.col("policy") == "model_priority").select("expected_revenue").scalar()
    return rev.withColumn(
        "model_uplift_pct", r6((model_rev / F.greatest(F.col("expected_revenue"), F.lit(1.0)) - 1) * 100)
    )


def rank_changes(ranked: DataFrame, n: int, pct: int = 10, plan: RankPlan = DEFAULT_PLAN) -> DataFrame:
    """B4 rows: for the n top-ranked users, |avg rank under +pct% P(churn) - avg rank under
    -pct%| where both rankings (descending, ties averaged) run over every user (null scores tie, last)."""
    moved = lambda f: clip(F.col("p_churn") * F.lit(f), 0.0, 1.0) * F.col("e_ltv")
    both = F.array(*[F.struct(F.lit(name).alias("perturbation"), moved(f).alias("score"))
                     for name, f in (("up", 1 + pct / 100), ("down", 1 - pct / 100))])
    long = ranked.select("user_key", "rank", F.explode(both).alias("_p")).select("user_key", "rank", "_p.*")
    places = average_rank_by_value(long, "score", group=["perturbation"], plan=plan)
    one = join_null_safe(long.filter(F.col("rank") <= n), places, ["perturbation", "score"])
    place = lambda name: F.max(F.when(F.col("perturbation") == name, F.col("avg_rank")))
    j = one.groupBy("user_key", "rank").agg(place("up").alias("r_up"), place("down").alias("r_dn"))
    return j.select("user_key", "rank", "r_up", "r_dn", F.abs(F.col("r_up") - F.col("r_dn")).alias("rank_change"))


def rank_sensitivity(changes: DataFrame, n: int) -> DataFrame:
    """B4 summary: median rank change, count and share moving more than n places."""
    med = exact_quantiles(changes, "rank_change", [0.5]).select(r6(F.col("value")).alias("median_rank_change"))
    a = changes.agg(
        F.count(F.lit(1)).alias("n_top"),
        F.count_if(F.col("rank_change") > n).alias("n_beyond_budget"),
        r6(F.avg(F.when(F.col("rank_change") > n, 1.0).otherwise(0.0)) * 100).alias("pct_beyond_budget"),
    )
    return a.withColumn("median_rank_change", med.scalar())


def rank_change_histogram(changes: DataFrame, n_bins: int = 50) -> DataFrame:
    """B4 histogram behind the sensitivity plot."""
    return equal_width_histogram(changes, "rank_change", n_bins)


def value_scatter_sample(pred: DataFrame, k: int = 20_000, seed: int = 42, zoom: float = 500.0) -> DataFrame:
    """B5 + P10: reproducible k-row sample of (actual, predicted) value with the zoom flag."""
    s = pred.select("user_key", F.col("value_true").alias("actual"), r6(exp_m1(F.col("value_pred_log"))).alias("predicted"))
    s = hash_sample(s, k, seed, "user_key")
    return s.withColumn("in_zoom", (F.col("actual") <= zoom) & (F.col("predicted") <= zoom))
