"""Query registry: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables through the role views, so its work grows with
them.  Column names equal those of the matching SQL in ``lapse.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapse.config import CHECKED
from lapse.operators import calibrate as cb
from lapse.operators import decide as dc
from lapse.operators import explore as ex
from lapse.sources import buckets as bk
from lapse.sources import ingest as ing
from lapse.operators import features as feat
from lapse.operators import modeltable as mt
from lapse.operators import metrics as me
from lapse.operators import selection as sl
from lapse.operators import scoring as sc
from lapse.functions.scalar import r6
from pyspark.sql import functions as F
from lapse.plans.context import Context
from lapse.session import ensure_checkpoint_dir
from lapse.sources.store import new_folder
from lapse.sources.tables import dataset_inventory

REGISTRY: dict[str, Callable[[Context], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn

    return deco


# ---- step 1: sources ------------------------------------------------------------------
@query("dataset_inventory")
def q_dataset_inventory(c: Context) -> DataFrame:
    return dataset_inventory(c.spark, c.root).select("table_name", "n_rows")


# ---- step 2: time-safe user table -----------------------------------------------------
@query("payment_profile")
def q_payment_profile(c: Context) -> DataFrame:
    return feat.payment_profile(c.txns, c.w)


@query("latest_payment_method")
def q_latest_payment_method(c: Context) -> DataFrame:
    return feat.latest_payment_method(c.txns, c.w)


@query("forward_value")
def q_forward_value(c: Context) -> DataFrame:
    return feat.forward_value(c.txns, c.w)


@query("engagement_window")
def q_engagement_window(c: Context) -> DataFrame:
    return feat.engagement_window(c.logs, c.w)


@query("user_base_table")
def q_user_base_table(c: Context) -> DataFrame:
    return c.base


@query("user_base_table_bucketed")
def q_user_base_table_bucketed(c: Context) -> DataFrame:
    """The base table over copies bucketed on the user key: no exchange between the facts and the label."""
    root = new_folder(c.spark, "bucketed")
    bk.bucket_roles(c.spark, c.root, root)
    return Context(c.spark, root, c.p, c.plan, bk.read_bucketed).base


@query("leakage_audit")
def q_leakage_audit(c: Context) -> DataFrame:
    return feat.leakage_audit(c.txns, c.logs, c.w)


@query("derived_features")
def q_derived_features(c: Context) -> DataFrame:
    return c.features.select(
        "user_key", "registration_tenure_days", "avg_song_completion", "total_secs_log",
        "log1p_ltv", "bd_clean", "gender",
    )


# ---- step 3: explore ------------------------------------------------------------------
@query("label_balance")
def q_label_balance(c: Context) -> DataFrame:
    return ex.label_balance(c.label)


@query("churn_by_gender")
def q_churn_by_gender(c: Context) -> DataFrame:
    return ex.churn_by_gender(c.label, c.members)


@query("churn_by_channel_topk")
def q_churn_by_channel_topk(c: Context) -> DataFrame:
    return ex.churn_by_channel_topk(c.label, c.members, c.p.top_channels)


@query("churn_by_age_band")
def q_churn_by_age_band(c: Context) -> DataFrame:
    return ex.churn_by_age_band(c.label, c.members)


@query("renew_cancel_signals")
def q_renew_cancel_signals(c: Context) -> DataFrame:
    return ex.renew_cancel_signals(c.label, c.txns)


@query("engagement_by_label")
def q_engagement_by_label(c: Context) -> DataFrame:
    return ex.engagement_by_label(c.label, c.logs)


@query("inactive_share")
def q_inactive_share(c: Context) -> DataFrame:
    return ex.inactive_share(c.label, c.logs)


@query("demographics_validity")
def q_demographics_validity(c: Context) -> DataFrame:
    return ex.demographics_validity(c.members)


@query("gender_counts")
def q_gender_counts(c: Context) -> DataFrame:
    return ex.gender_counts(c.members)


@query("registrations_by_year")
def q_registrations_by_year(c: Context) -> DataFrame:
    lo, hi = c.p.reg_year_range
    return ex.registrations_by_year(c.members, lo, hi)


@query("age_histogram")
def q_age_histogram(c: Context) -> DataFrame:
    return ex.age_histogram(c.members, c.p.n_hist_bins)


# ---- step 5/6: split, imputation, encoding, scaling -----------------------------------
@query("stratified_split")
def q_stratified_split(c: Context) -> DataFrame:
    return c.split


@query("split_profile")
def q_split_profile(c: Context) -> DataFrame:
    return mt.split_profile(c.model_table)


@query("hash_sample")
def q_hash_sample(c: Context) -> DataFrame:
    return sl.hash_sample(c.features.select("user_key", "is_churn", "ltv"), 100, c.p.seed, "user_key")


@query("median_imputation")
def q_median_imputation(c: Context) -> DataFrame:
    return c.builder.medians().select("feature", r6("median").alias("median"))


@query("category_map")
def q_category_map(c: Context) -> DataFrame:
    return c.builder.category_map()


@query("encoded_features")
def q_encoded_features(c: Context) -> DataFrame:
    return c.builder.encoded().select("user_key", "split", *mt.ENC_COLS)


@query("scaled_features")
def q_scaled_features(c: Context) -> DataFrame:
    return c.model_table.select("user_key", "split", *mt.SCALED_COLS)


@query("model_table")
def q_model_table(c: Context) -> DataFrame:
    return c.model_table


@query("feature_manifest")
def q_feature_manifest(c: Context) -> DataFrame:
    return c.manifest.select("feature", "column", "cardinality", "embedding_dim", "unknown_index")


@query("class_weight")
def q_class_weight(c: Context) -> DataFrame:
    return mt.class_weight(c.split.filter(F.col("split") == "train"))


# ---- step 7: metrics on the closed-form scores ----------------------------------------
@query("predictions")
def q_predictions(c: Context) -> DataFrame:
    return c.predictions


@query("auc_by_model")
def q_auc_by_model(c: Context) -> DataFrame:
    return me.ranking_metrics(me.score_curve(c.predictions, plan=c.plan)).select("model_id", "split", "auc_roc")


@query("average_precision")
def q_average_precision(c: Context) -> DataFrame:
    return me.ranking_metrics(me.score_curve(c.predictions, plan=c.plan)).select(
        "model_id", "split", "average_precision")


@query("value_errors")
def q_value_errors(c: Context) -> DataFrame:
    return me.value_errors(c.predictions)


@query("roc_points")
def q_roc_points(c: Context) -> DataFrame:
    return me.roc_points(me.score_curve(c.predictions, plan=c.plan))


@query("pr_points")
def q_pr_points(c: Context) -> DataFrame:
    return me.pr_points(me.score_curve(c.predictions, plan=c.plan))


@query("reliability_bins")
def q_reliability_bins(c: Context) -> DataFrame:
    test = c.predictions.filter((F.col("model_id") == "joint") & (F.col("split") == "test"))
    return me.reliability_bins(test, c.p.n_reliability_bins)


@query("reliability_points")
def q_reliability_points(c: Context) -> DataFrame:
    test = c.predictions.filter((F.col("model_id") == "joint") & (F.col("split") == "test"))
    return me.reliability_points(me.reliability_bins(test, c.p.n_reliability_bins))


@query("ece")
def q_ece(c: Context) -> DataFrame:
    return me.expected_calibration_error(c.predictions, c.p.n_reliability_bins)


@query("model_metrics")
def q_model_metrics(c: Context) -> DataFrame:
    return c.metrics


@query("model_comparison")
def q_model_comparison(c: Context) -> DataFrame:
    return me.model_comparison(c.metrics, sc.CHURN_CEILING_MODEL, sc.VALUE_CEILING_MODEL)


@query("tradeoff_frontier")
def q_tradeoff_frontier(c: Context) -> DataFrame:
    return me.tradeoff_frontier(c.metrics)


# ---- step 8: calibration --------------------------------------------------------------
@query("isotonic_calibrated")
def q_isotonic_calibrated(c: Context) -> DataFrame:
    return c.calibrated_test.select("user_key", "score", "p_iso")


@query("calibration_summary")
def q_calibration_summary(c: Context) -> DataFrame:
    return me.calibration_summary(c.calibrated_test)


@query("final_model_metrics")
def q_final_model_metrics(c: Context) -> DataFrame:
    """Selected model after isotonic calibration, test split: every metric on P(churn)."""
    cal = c.calibrated_test.select(
        F.lit("joint_isotonic").alias("model_id"), "split", "user_key", "is_churn", F.col("p_iso").alias("score"),
        "value_pred_log", "value_true", "value_true_log")
    return me.model_metrics(cal, plan=c.plan)


@query("temperature_scaled")
def q_temperature_scaled(c: Context) -> DataFrame:
    t = cb.rounded(cb.temperature_fit(c.model_split("joint", "val")))
    return cb.temperature_apply(c.model_split("joint", "test"), t).select(
        "user_key", "score", "p_temp", F.lit(t).alias("temperature"))


@query("calibration_ece")
def q_calibration_ece(c: Context) -> DataFrame:
    t = cb.rounded(cb.temperature_fit(c.model_split("joint", "val")))
    test = cb.temperature_apply(c.calibrated_test, t)
    parts = [
        me.expected_calibration_error(test.withColumn("method", F.lit(m)), c.p.n_reliability_bins, prob=col,
                                      group=["method"])
        for m, col in (("uncalibrated", "score"), ("temperature", "p_temp"), ("isotonic", "p_iso"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- step 9: decisions ------------------------------------------------------------------
@query("priority_scores")
def q_priority_scores(c: Context) -> DataFrame:
    return c.ranked


@query("priority_head")
def q_priority_head(c: Context) -> DataFrame:
    return c.ranked.filter(F.col("rank") <= 5)


@query("segment_representatives")
def q_segment_representatives(c: Context) -> DataFrame:
    return dc.segment_representatives(c.ranked)


@query("budget_policies")
def q_budget_policies(c: Context) -> DataFrame:
    return dc.budget_policies(c.ranked_raw, c.p.budget, c.p.seed)


@query("rank_sensitivity")
def q_rank_sensitivity(c: Context) -> DataFrame:
    return dc.rank_sensitivity(c.rank_changes, c.p.budget.n_interventions)


@query("rank_change_histogram")
def q_rank_change_histogram(c: Context) -> DataFrame:
    return dc.rank_change_histogram(c.rank_changes, c.p.n_hist_bins)


@query("value_scatter_sample")
def q_value_scatter_sample(c: Context) -> DataFrame:
    return dc.value_scatter_sample(c.model_split("joint", "test"), k=c.p.scatter_rows, seed=c.p.seed)


# ---- step 10: learners and ingest ------------------------------------------------------
@query("churn_scorer")
def q_churn_scorer(c: Context) -> DataFrame:
    return c.learners.churn_scorer()


@query("value_regressor")
def q_value_regressor(c: Context) -> DataFrame:
    return c.learners.value_regressor()


@query("interaction_scorer")
def q_interaction_scorer(c: Context) -> DataFrame:
    return c.learners.interaction_scorer()


@query("interaction_regressor")
def q_interaction_regressor(c: Context) -> DataFrame:
    return c.learners.interaction_regressor()


@query("learner_metrics")
def q_learner_metrics(c: Context) -> DataFrame:
    """Every metric per (learner, split): four single heads and the joined model."""
    return me.model_metrics(c.learned_heads, plan=c.plan)


@query("learned_priority")
def q_learned_priority(c: Context) -> DataFrame:
    """Learned heads -> isotonic calibration -> priority ranking of the test users."""
    return c.learned_ranked


@query("churn_by_gender_report")
def q_churn_by_gender_report(c: Context) -> DataFrame:
    """F8: the report form at one decimal."""
    return ex.churn_by_gender(c.label, c.members, decimals=1)


def _ingested(c: Context, table: str, write_csv) -> DataFrame:
    base = new_folder(c.spark, "ingest")
    write_csv(c.spark, c.root, f"{base}/csv")
    ing.convert(c.spark, table, f"{base}/csv", f"{base}/parquet")
    return c.spark.read.parquet(f"{base}/parquet")


@query("typed_ingest_members")
def q_typed_ingest_members(c: Context) -> DataFrame:
    """Customers -> raw members CSV (empty genders) -> declared-schema Parquet."""
    return _ingested(c, "members", ing.members_csv_from_customer)


@query("typed_ingest_user_logs")
def q_typed_ingest_user_logs(c: Context) -> DataFrame:
    """Events -> raw user_logs CSV (float seconds) -> declared-schema Parquet."""
    return _ingested(c, "user_logs", ing.user_logs_csv_from_events)


@query("typed_ingest")
def q_typed_ingest(c: Context) -> DataFrame:
    """Orders -> raw transactions CSV -> declared-schema, FAILFAST, no-null-checked Parquet."""
    return _ingested(c, "transactions", ing.transactions_csv_from_orders)


RAW_WRITERS = {"members": ing.members_csv_from_customer, "transactions": ing.transactions_csv_from_orders,
               "user_logs": ing.user_logs_csv_from_events}


@query("ingest_report")
def q_ingest_report(c: Context) -> DataFrame:
    """Rows, nulls per column and bytes of the loads of all raw tables, the bytes against the files that a
    reader of the output sees."""
    base = new_folder(c.spark, "ingest-report")
    for table, write in RAW_WRITERS.items():
        write(c.spark, c.root, f"{base}/csv/{table}")
    reports = ing.load_all(c.spark, f"{base}/csv", f"{base}/parquet", list(RAW_WRITERS))
    seen = dataset_inventory(c.spark, f"{base}/parquet", list(RAW_WRITERS)).select(
        F.col("table_name"), F.col("n_bytes").alias("_bytes"), F.col("n_rows").alias("_rows"))
    return ing.report_rows(c.spark, reports).join(seen, "table_name").select(
        "table_name", "column_name", "n_rows", "n_nulls", (F.col("n_bytes") == F.col("_bytes")).alias("bytes_seen"),
        (F.col("n_rows") == F.col("_rows")).alias("rows_seen"))


@query("churn_by_city_sql")
def q_churn_by_city_sql(c: Context) -> DataFrame:
    """Spark SQL over the registered views: churn and forward payments by city."""
    return c.sql("""
        SELECT m.city, count(*) AS n, sum(l.is_churn) AS n_churned, count(p.user_key) AS n_paying
        FROM label l JOIN members m USING (user_key)
        LEFT JOIN (SELECT DISTINCT user_key FROM transactions WHERE is_cancel = 0) p ON p.user_key = l.user_key
        GROUP BY m.city""")


def bind(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = REGISTRY[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(Context(spark, sf_dir, CHECKED))

    run.__name__ = f"q_{name}"
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: bind(name) for name in REGISTRY}
