"""Evaluation over a prediction table.

Ranking metrics come from one *score curve*: rows aggregated to one per
(group, distinct score) — hot scores are combined map-side — then running true /
false positive counts in descending score order via the bucketed prefix sum
(``ordered_running``).  From that table:

* ROC-AUC (ties count one half): sum tp(s) * (negatives below s + fp(s) / 2) / (P * N)
* average precision (step sum, not trapezoid): sum tp(s) / P * precision(s)
* ROC and precision-recall point tables.

Groups are ``(model_id, split)``; per-group positives and negatives come with the
running sums (bucket totals), not from another aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.functions.scalar import exp_m1, r6
from lapse.operators.ranking import DEFAULT_PLAN, RankPlan, ordered_running

GROUP = ("model_id", "split")


def score_curve(pred: DataFrame, *, group: Sequence[str] = GROUP, score: str = "score", label: str = "is_churn",
                plan: RankPlan = DEFAULT_PLAN) -> DataFrame:
    """(group, score, tp, fp, tp_cum, fp_cum, n_pos, n_neg); cumulative in descending score."""
    group = list(group)
    d = pred.filter(F.col(score).isNotNull()).groupBy(*group, score).agg(
        F.sum(F.col(label)).cast("long").alias("tp"),
        (F.count(F.lit(1)) - F.sum(F.col(label))).cast("long").alias("fp"),
    )
    r = ordered_running(d, score, descending=True, group=group, sums=["tp", "fp"], pos_col="_spos", totals=True,
                        plan=plan)
    return r.withColumnRenamed("tp_total", "n_pos").withColumnRenamed("fp_total", "n_neg").drop("_rows_total")


def ranking_metrics(curve: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """M1 + M2 per group: auc_roc, average_precision (null when a class is absent)."""
    auc_num = F.sum(F.col("tp").cast("double") * (F.col("n_neg") - F.col("fp_cum") + F.col("fp") / 2.0))
    ap_terms = F.sum(
        F.try_divide(F.col("tp").cast("double"), F.col("n_pos")) * F.col("tp_cum") / (F.col("tp_cum") + F.col("fp_cum"))
    )
    a = curve.groupBy(*group).agg(
        auc_num.alias("_auc_num"), ap_terms.alias("_ap"), F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg")
    )
    valid = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return a.select(
        *group,
        r6(F.when(valid, F.try_divide(F.col("_auc_num"), F.col("n_pos").cast("double") * F.col("n_neg")))).alias("auc_roc"),
        r6(F.when(F.col("n_pos") > 0, F.col("_ap"))).alias("average_precision"),
    )


def _with_end(curve: DataFrame, group: list[str], point: list[Column], end: list[Column]) -> DataFrame:
    """A point per distinct score, and one end point beside the first score of each group."""
    both = F.when(F.col("_spos") == 1, F.array(F.struct(*point), F.struct(*end))).otherwise(F.array(F.struct(*point)))
    return curve.select(*group, F.explode(both).alias("_p")).select(*group, "_p.*")


def roc_points(curve: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """M4: one (fpr, tpr) row per distinct score plus the (0, 0) start at threshold +inf."""
    point = [
        F.col("score").cast("double").alias("threshold"),
        r6(F.try_divide(F.col("fp_cum").cast("double"), F.col("n_neg"))).alias("fpr"),
        r6(F.try_divide(F.col("tp_cum").cast("double"), F.col("n_pos"))).alias("tpr"),
    ]
    return _with_end(curve, list(group), point, [F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")])


def pr_points(curve: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """M5: one (recall, precision) row per distinct score plus the (0, 1) end point."""
    point = [
        F.col("score").cast("double").alias("threshold"),
        r6(F.try_divide(F.col("tp_cum").cast("double"), F.col("n_pos"))).alias("recall"),
        r6(F.col("tp_cum").cast("double") / (F.col("tp_cum") + F.col("fp_cum"))).alias("precision"),
    ]
    end = [F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision")]
    return _with_end(curve, list(group), point, end)


# ---- M6: calibration bins -----------------------------------------------------------------
def bin_edges(n_bins: int) -> list[float]:
    """Edges of ``n_bins`` equal bins over [0, 1] as ``linspace`` gives them (so 0.3 sits
    just below its edge 0.30000000000000004)."""
    return [float(x) for x in np.linspace(0.0, 1.0, n_bins + 1)]


def bin_index(p: Column, n_bins: int) -> Column:
    """Bin of a probability: [lo, hi) except the last, closed; outside [0, 1] -> null."""
    edges = bin_edges(n_bins)
    out = F.lit(n_bins - 1)
    for i in range(n_bins - 2, -1, -1):
        out = F.when(p < F.lit(edges[i + 1]), F.lit(i)).otherwise(out)
    return F.when((p >= F.lit(0.0)) & (p <= F.lit(1.0)), out)


def reliability_bins(pred: DataFrame, n_bins: int = 10, prob: str = "score", label: str = "is_churn") -> DataFrame:
    """(bin, bin_lo, bin_hi, bin_mid, n, avg_conf, avg_acc); empty bins kept with n = 0."""
    edges = bin_edges(n_bins)
    agg = pred.groupBy(bin_index(F.col(prob), n_bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(prob).alias("_conf"), F.avg(F.col(label).cast("double")).alias("_acc")
    ).filter(F.col("bin").isNotNull())
    lo = F.element_at(F.array(*[F.lit(e) for e in edges[:-1]]), F.col("bin") + 1)
    hi = F.element_at(F.array(*[F.lit(e) for e in edges[1:]]), F.col("bin") + 1)
    bins = pred.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    return bins.join(agg, "bin", "left").select(
        "bin", lo.alias("bin_lo"), hi.alias("bin_hi"), r6((lo + hi) / 2).alias("bin_mid"),
        F.coalesce(F.col("_n"), F.lit(0)).alias("n"), r6(F.col("_conf")).alias("avg_conf"),
        r6(F.col("_acc")).alias("avg_acc"),
    )


def reliability_points(bins: DataFrame) -> DataFrame:
    """The diagram's points — bins that hold at least one row (null averages dropped)."""
    return bins.dropna(subset=["avg_conf", "avg_acc"])


def calibration_summary(cal: DataFrame, raw: str = "score", calibrated: str = "p_iso",
                        label: str = "is_churn") -> DataFrame:
    """Distinct calibrated values and mean prediction (raw and calibrated) vs truth."""
    return cal.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(calibrated).alias("n_distinct_calibrated"),
        r6(F.avg(raw)).alias("mean_raw"),
        r6(F.avg(calibrated)).alias("mean_calibrated"),
        r6(F.avg(F.col(label).cast("double"))).alias("churn_rate"),
    )


def calibration_results(cal: DataFrame, methods: dict[str, str], temperature: float, n_bins: int = 10,
                        label: str = "is_churn") -> DataFrame:
    """One row per method (name -> probability column): error before and after calibration, distinct values and mean
    prediction against the truth, and the temperature of the method that has one."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(c).cast("double").alias("p")) for m, c in methods.items()]))
    long = cal.select(F.col(label), each.alias("e")).select(label, "e.*")
    facts = long.groupBy("method").agg(
        F.count_distinct("p").alias("n_distinct"), r6(F.avg("p")).alias("mean_prediction"), r6(F.avg(F.col(label).cast("double"))).alias("churn_rate"))
    ece = expected_calibration_error(long, n_bins, prob="p", label=label, group=["method"])
    return ece.join(facts, "method").withColumn("temperature", F.when(F.col("method") == "temperature", F.lit(float(temperature))))


def expected_calibration_error(pred: DataFrame, n_bins: int = 10, prob: str = "score", label: str = "is_churn",
                               group: Sequence[str] = GROUP) -> DataFrame:
    """ECE per group: sum over bins of n_b / N * |avg_conf - avg_acc|; N counts every row,
    including probabilities outside [0, 1] that fall in no bin."""
    group = list(group)
    per_bin = pred.groupBy(*group, bin_index(F.col(prob), n_bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(prob).alias("_conf"), F.avg(F.col(label).cast("double")).alias("_acc")
    )
    return per_bin.groupBy(*group).agg(
        r6(F.sum(F.when(F.col("bin").isNotNull(), F.col("_n") * F.abs(F.col("_conf") - F.col("_acc"))))
           / F.sum("_n")).alias("ece"),
        F.sum("_n").alias("n"),
    )


# ---- M3 / M9 ----------------------------------------------------------------------------------
def value_errors(pred: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """M3: RMSE on the log scale, RMSE / MAE / R² on the raw scale (expm1 of the prediction)."""
    p = pred.filter(F.col("value_pred_log").isNotNull())
    raw_err = exp_m1(F.col("value_pred_log")) - F.col("value_true")
    return p.groupBy(*group).agg(
        r6(F.sqrt(F.avg(F.pow(F.col("value_pred_log") - F.col("value_true_log"), 2)))).alias("rmse_log"),
        r6(F.sqrt(F.avg(F.pow(raw_err, 2)))).alias("rmse_raw"),
        r6(F.avg(F.abs(raw_err))).alias("mae_raw"),
        r6(F.lit(1.0) - F.try_divide(F.sum(F.pow(raw_err, 2)), F.count(F.lit(1)) * F.var_pop("value_true"))).alias("r2_raw"),
    )


def base_rates(pred: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """M9: churn base rate per group."""
    return pred.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), r6(F.avg(F.col("is_churn").cast("double"))).alias("base_rate"))


def model_metrics(pred: DataFrame, plan: RankPlan = DEFAULT_PLAN, group: Sequence[str] = GROUP) -> DataFrame:
    """Every metric per (model, split), plus the PR lift over the base rate (M9)."""
    group = list(group)
    rm = ranking_metrics(score_curve(pred, group=group, plan=plan), group)
    out = base_rates(pred, group).join(rm, group, "left").join(value_errors(pred, group), group, "left")
    return out.withColumn("pr_lift", r6(F.try_divide(F.col("average_precision"), F.col("base_rate"))))


def model_comparison(metrics: DataFrame, churn_ceiling: str, value_ceiling: str, split: str = "test") -> DataFrame:
    """M11 + U2: ablation-style table; single-task rows carry only their own metric, the
    ceilings are the churn-only AUC and the value-only log RMSE, and each row is flagged."""
    m = metrics.filter(F.col("split") == split)
    churn_row = m.filter(F.col("model_id") == churn_ceiling).select("model_id", F.col("auc_roc").alias("test_auc"))
    value_row = m.filter(F.col("model_id") == value_ceiling).select("model_id", F.col("rmse_log").alias("test_rmse_log"))
    multi = m.filter(~F.col("model_id").isin(churn_ceiling, value_ceiling)).select(
        "model_id", F.col("auc_roc").alias("test_auc"), F.col("rmse_log").alias("test_rmse_log")
    )
    table = churn_row.unionByName(value_row, allowMissingColumns=True).unionByName(multi, allowMissingColumns=True)
    ceil_auc = churn_row.select("test_auc").scalar()
    ceil_rmse = value_row.select("test_rmse_log").scalar()
    auc_ok = F.col("test_auc") >= ceil_auc
    rmse_ok = F.col("test_rmse_log") <= ceil_rmse
    return table.select(
        "model_id", "test_auc", "test_rmse_log", ceil_auc.alias("ceiling_auc"), ceil_rmse.alias("ceiling_rmse_log"),
        auc_ok.alias("auc_at_ceiling"), rmse_ok.alias("rmse_at_ceiling"),
        F.coalesce(auc_ok & rmse_ok, F.lit(False)).alias("beats_both"),
    )


def tradeoff_frontier(metrics: DataFrame, split: str = "test") -> DataFrame:
    """M12 (our addition): models with both metrics that no other model dominates
    (AUC no lower and log RMSE no higher, one strictly).  Rows = models: a bounded handful."""
    m = metrics.filter((F.col("split") == split) & F.col("auc_roc").isNotNull() & F.col("rmse_log").isNotNull()).select(
        "model_id", "auc_roc", "rmse_log"
    )
    o = m.select(F.col("model_id").alias("o_id"), F.col("auc_roc").alias("o_auc"), F.col("rmse_log").alias("o_rmse"))
    dominated = (
        (F.col("o_auc") >= F.col("auc_roc")) & (F.col("o_rmse") <= F.col("rmse_log"))
        & ((F.col("o_auc") > F.col("auc_roc")) | (F.col("o_rmse") < F.col("rmse_log")))
    )
    return m.join(F.broadcast(o), dominated, "left_anti")
