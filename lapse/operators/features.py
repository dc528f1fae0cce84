"""Feature pipeline: time-safe user table (E1), derived features (E2), leakage audit.

Scale notes
-----------
* Transactions are scanned once: one conditional aggregation yields the pre-cutoff
  payment profile (A1), the latest pre-cutoff payment method (W1, ``max_by`` over a
  total order instead of a ranked window) and the forward revenue target (A2).
* Every fact is reduced to one row per ``user_key`` (partial aggregate map-side, so a
  user holding a third of all rows is combined before the shuffle) before the joins.
* The joins are left equi-joins on ``user_key``; all inputs are hash-partitioned on the
  key, so each side shuffles once.  No side is broadcast by hint: members and labels grow
  with the user count; AQE may still pick a broadcast at run time when a side is measured
  below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.config import Windows
from lapse.functions.scalar import (
    MAX_DAILY_SECS, clip, completion_rate, ln1p, r6, tenure_days, valid_age, ymd_to_date,
)
from lapse.operators.daybits import active_days
from lapse.sources.roles import log_ts_between, ts_between, ts_on_or_before

# fixed values: completion counters and the columns they sum to
COMPLETION_SUMS = {"num_25": "sum25", "num_50": "sum50", "num_75": "sum75", "num_985": "sum985", "num_100": "sum100"}


def latest_order_key() -> F.Column:
    """Total order (txn_date, txn_id) packed into one DECIMAL(38,0): days * 2^64 + txn_id + 2^63.

    ``max_by`` over a struct would need a SortAggregate (struct buffers are not
    hash-aggregatable); a decimal key keeps the aggregate a HashAggregate and holds every BIGINT id.
    """
    days = F.unix_date("txn_date").cast("decimal(10,0)") * F.lit(Decimal(2 ** 64))
    return (days + F.col("txn_id").cast("decimal(20,0)") + F.lit(Decimal(2 ** 63))).cast("decimal(38,0)")


def _money_avg(x) -> F.Column:
    """Average of a DECIMAL money column as double: exact sum / count."""
    return F.sum(x).cast("double") / F.count(x)


def transaction_profile(txns: DataFrame, w: Windows) -> DataFrame:
    """One pass over payments -> per-user profile before the cutoff plus the forward target.

    Columns: num_transactions, avg_payment_plan_days, avg_actual_amount_paid,
    is_auto_renew_rate, payment_method_id (latest before cutoff; ties on the date go to
    the larger ``txn_id``), ltv (forward revenue, DECIMAL exact then double).
    """
    pre = ts_on_or_before(F.col("txn_ts"), w.feature_cutoff)
    fwd = ts_between(F.col("txn_ts"), w.value_start, w.value_end)
    return (
        txns.filter(pre | fwd)
        .groupBy("user_key")
        .agg(
            F.count_if(pre).alias("num_transactions"),
            F.avg(F.when(pre, F.col("payment_plan_days"))).alias("avg_payment_plan_days"),
            _money_avg(F.when(pre, F.col("actual_amount_paid"))).alias("avg_actual_amount_paid"),
            F.avg(F.when(pre, F.col("is_auto_renew"))).alias("is_auto_renew_rate"),
            F.max_by("payment_method_id", F.when(pre, latest_order_key())).alias("payment_method_id"),
            F.sum(F.when(fwd, F.col("actual_amount_paid"))).cast("double").alias("ltv"),
        )
    )


def payment_profile(txns: DataFrame, w: Windows) -> DataFrame:
    """A1: pre-cutoff count / averages / renew rate per user (users with a pre-cutoff payment)."""
    pre = txns.filter(ts_on_or_before(F.col("txn_ts"), w.feature_cutoff))
    return pre.groupBy("user_key").agg(
        F.count(F.lit(1)).alias("num_transactions"),
        F.avg("payment_plan_days").alias("avg_payment_plan_days"),
        _money_avg(F.col("actual_amount_paid")).alias("avg_actual_amount_paid"),
        F.avg("is_auto_renew").alias("is_auto_renew_rate"),
    )


def latest_payment_method(txns: DataFrame, w: Windows) -> DataFrame:
    """Payment method of the latest pre-cutoff payment, total order (date, txn_id)."""
    pre = txns.filter(ts_on_or_before(F.col("txn_ts"), w.feature_cutoff))
    return pre.groupBy("user_key").agg(
        F.max_by("payment_method_id", latest_order_key()).alias("payment_method_id"),
        F.max("txn_date").alias("latest_txn_date"),
    )


def forward_value(txns: DataFrame, w: Windows) -> DataFrame:
    """A2: revenue per user in the closed target window."""
    fwd = txns.filter(ts_between(F.col("txn_ts"), w.value_start, w.value_end))
    return fwd.groupBy("user_key").agg(F.sum("actual_amount_paid").cast("double").alias("ltv"))


def engagement_window(logs: DataFrame, w: Windows) -> DataFrame:
    """A3: distinct active days (a bitmap of the window's days), clipped seconds and completion counters.

    Seconds are clipped to [0, 86400] per row; a null (or NaN) becomes 86400 because
    ``least`` skips nulls — the documented behaviour of the original SQL.
    """
    win = logs.filter(log_ts_between(F.col("log_ts"), w.engagement_start, w.engagement_end))
    secs = clip(F.col("total_secs").cast("double"), 0.0, float(MAX_DAILY_SECS))
    sums = {"total_secs_sum": secs, **{dst: F.col(src) for src, dst in COMPLETION_SUMS.items()}}
    per_user = active_days(win, "user_key", "log_date", (w.engagement_start, w.engagement_end), sums, "daily_active_days")
    return per_user.withColumn("total_secs_sum", r6(F.col("total_secs_sum")))


# fixed values: columns of the user table, in order
BASE_COLUMNS = [
    "user_key", "is_churn", "ltv", "city", "bd", "gender", "registered_via", "registration_init_time",
    "num_transactions", "avg_payment_plan_days", "avg_actual_amount_paid", "is_auto_renew_rate",
    "payment_method_id", "daily_active_days", "total_secs_sum", "sum25", "sum50", "sum75", "sum985", "sum100",
]


def user_base_table(label: DataFrame, members: DataFrame, txns: DataFrame, logs: DataFrame, w: Windows) -> DataFrame:
    """Label ⟕ members ⟕ transaction profile ⟕ engagement, with the COALESCE rules.

    Counts, renew rate, LTV and engagement sums default to 0; the two averages stay null
    (imputed later, fitted on train only).
    """
    tx = transaction_profile(txns, w)
    eng = engagement_window(logs, w)
    j = label.join(members, "user_key", "left").join(tx, "user_key", "left").join(eng, "user_key", "left")
    zero = {
        "ltv": 0.0, "num_transactions": 0, "is_auto_renew_rate": 0.0, "daily_active_days": 0,
        "total_secs_sum": 0.0, "sum25": 0, "sum50": 0, "sum75": 0, "sum985": 0, "sum100": 0,
    }
    return j.select(
        *[
            (F.coalesce(F.col(c), F.lit(zero[c])).alias(c) if c in zero else F.col(c))
            for c in BASE_COLUMNS
        ]
    )


def derived_features(base: DataFrame, w: Windows) -> DataFrame:
    """Tenure, weighted completion, log transforms, clean age, gender default."""
    return base.withColumns(
        {
            "registration_tenure_days": tenure_days(ymd_to_date("registration_init_time"), w.feature_cutoff),
            "avg_song_completion": r6(completion_rate()),
            "total_secs_log": r6(ln1p("total_secs_sum")),
            "log1p_ltv": r6(ln1p("ltv")),
            "bd_clean": valid_age(F.col("bd")).cast("double"),
            "gender": F.coalesce(F.col("gender"), F.lit("unknown")),
        }
    )


def leakage_audit(txns: DataFrame, logs: DataFrame, w: Windows) -> DataFrame:
    """One row on the rows that the feature table and the target really use.

    Rows are chosen as ``transaction_profile`` and ``engagement_window`` choose them, by their
    timestamps; what is checked is their business dates, so a row that is dated later than its
    timestamp says, or a window that reaches past the cutoff, makes the table unsafe.
    """
    pre = ts_on_or_before(F.col("txn_ts"), w.feature_cutoff)
    fwd = ts_between(F.col("txn_ts"), w.value_start, w.value_end)
    a = txns.agg(
        F.max(F.when(pre, F.col("txn_date"))).alias("max_feature_date"),
        F.min(F.when(fwd, F.col("txn_date"))).alias("min_target_date"),
        F.count_if(pre).alias("n_feature_rows"),
        F.count_if(fwd).alias("n_target_rows"),
        F.count_if(pre & fwd).alias("n_overlap"),
    )
    used = logs.filter(log_ts_between(F.col("log_ts"), w.engagement_start, w.engagement_end))
    b = used.agg(F.max("log_date").alias("max_log_date"), F.count(F.lit(1)).alias("n_log_rows"))
    cutoff = F.lit(w.feature_cutoff)
    return a.crossJoin(b).withColumn(  # one row each
        "is_time_safe",
        F.coalesce(F.col("max_feature_date") <= cutoff, F.lit(True))
        & F.coalesce(F.col("max_log_date") <= cutoff, F.lit(True))
        & F.coalesce(F.col("min_target_date") > cutoff, F.lit(True))
        & (F.col("n_overlap") == 0),
    )


__all__ = [
    "transaction_profile", "payment_profile", "latest_payment_method", "forward_value",
    "engagement_window", "user_base_table", "derived_features", "leakage_audit", "latest_order_key",
]
