"""Exploratory aggregates over the role views.

Totals that a ratio needs are scalar subqueries (``DataFrame.scalar()``): Spark runs them
as their own distributed aggregate and inlines the value, so no window without a
partition and no cross join is needed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.operators.daybits import active_days, day_span
from lapse.functions.scalar import age_band, hours, r6, round_half_up, segment_label, valid_age, year_of_ymd

PCT = 100.0


def rate(x: F.Column, decimals: int = 6) -> F.Column:
    """Percent / average outputs: 6 decimals by default (engine-neutral half-up); the
    1-decimal report form is ``decimals=1``."""

    return r6(x) if decimals == 6 else round_half_up(x.cast("double"), decimals)


def _churn_rate_by(df: DataFrame, key: F.Column, name: str, decimals: int = 6) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(
        F.count(F.lit(1)).alias("n"),
        rate(F.avg("is_churn") * PCT, decimals).alias("churn_pct"),
    )


def label_balance(label: DataFrame) -> DataFrame:
    """A4: rows per label value with the share of all labelled users in percent."""
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # over one row per label value
    return label.groupBy("is_churn").agg(F.count(F.lit(1)).alias("n")).withColumn("pct", r6(F.col("n") * PCT / total))


def labelled_members(label: DataFrame, members: DataFrame) -> DataFrame:
    """Label ⟕ members (members attributes null where the user has no member row)."""
    return label.join(members, "user_key", "left")


def churn_by_gender(label: DataFrame, members: DataFrame, decimals: int = 6) -> DataFrame:
    """A5 + P5: churn rate per gender, null gender as 'unknown'."""
    j = labelled_members(label, members)
    return _churn_rate_by(j, F.coalesce(F.col("gender"), F.lit("unknown")), "gender", decimals)


def churn_by_channel_topk(label: DataFrame, members: DataFrame, k: int = 8, decimals: int = 6) -> DataFrame:
    """A5 + T1: the k largest registration channels with their churn rate.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: per-partition top-k, then
    a k-row merge.  Ties on ``n`` break on the channel (nulls last) so the cut is exact.
    """
    j = labelled_members(label, members)
    agg = _churn_rate_by(j, F.col("registered_via"), "registered_via", decimals)
    return agg.orderBy(F.desc("n"), F.asc_nulls_last("registered_via")).limit(k)


def churn_by_age_band(label: DataFrame, members: DataFrame, decimals: int = 6) -> DataFrame:
    """A5 + P6: churn rate per age band."""
    j = labelled_members(label, members)
    return _churn_rate_by(j, age_band(F.col("bd")), "age_bucket", decimals)


def latest_transaction_flags(txns: DataFrame, cutoff=None) -> DataFrame:
    """W1 over all columns needed: latest payment per user (optionally before ``cutoff``).

    Two ``max_by`` over one packed DECIMAL order key keep it a single HashAggregate.
    """
    from lapse.operators.features import latest_order_key
    from lapse.sources.roles import ts_on_or_before

    src = txns if cutoff is None else txns.filter(ts_on_or_before(F.col("txn_ts"), cutoff))
    key = latest_order_key()
    return src.groupBy("user_key").agg(
        F.max_by("is_auto_renew", key).alias("is_auto_renew"),
        F.max_by("is_cancel", key).alias("is_cancel"),
    )


def renew_cancel_signals(label: DataFrame, txns: DataFrame, cutoff=None, decimals: int = 6) -> DataFrame:
    """A6 + J3 + F10: churn rate by (auto-renew, cancel) of the latest payment."""
    latest = latest_transaction_flags(txns, cutoff)
    j = latest.join(label, "user_key", "inner")
    return (
        j.groupBy("is_auto_renew", "is_cancel")
        .agg(F.count(F.lit(1)).alias("n"), rate(F.avg("is_churn") * PCT, decimals).alias("churn_pct"))
        .withColumn("segment", segment_label(F.col("is_auto_renew"), F.col("is_cancel")))
    )


def engagement_by_label(label: DataFrame, logs: DataFrame, decimals: int = 6) -> DataFrame:
    """A7 + J4: per-user active days and hours (all logs, unclipped), averaged per label.

    Days are bitmaps over the span of all logs, so the logs shuffle once.  Users without logs count in
    ``n`` but not in the averages (null after the left join).
    """
    span = day_span(logs, "log_date") or (dt.date(1970, 1, 1), dt.date(1970, 1, 1))
    per_user = active_days(logs, "user_key", "log_date", span, {"secs": F.col("total_secs")}, "active_days").select(
        "user_key", "active_days", hours(F.col("secs")).alias("total_hours"))
    j = label.join(per_user, "user_key", "left")
    return j.groupBy("is_churn").agg(
        F.count(F.lit(1)).alias("n"),
        rate(F.avg("active_days"), decimals).alias("avg_active_days"),
        rate(F.avg("total_hours"), decimals).alias("avg_total_hours"),
    )


def inactive_share(label: DataFrame, logs: DataFrame, decimals: int = 6) -> DataFrame:
    """J5 + U1: percent of labelled users with no activity row at all."""
    seen = logs.select("user_key").distinct().withColumn("_seen", F.lit(1))
    j = label.join(seen, "user_key", "left")
    return j.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.count_if(F.col("_seen").isNull()).alias("n_inactive"),
        rate(F.avg(F.when(F.col("_seen").isNull(), 1).otherwise(0)) * PCT, decimals).alias("pct_inactive"),
    )


def demographics_validity(members: DataFrame) -> DataFrame:
    """Percent of members with a valid age (1..100) and with unknown gender."""
    return members.agg(
        F.count(F.lit(1)).alias("n_members"),
        r6(F.avg(F.when((F.col("bd") > 0) & (F.col("bd") <= 100), 1).otherwise(0)) * PCT).alias("pct_valid_age"),
        r6(F.avg(F.when(F.col("gender").isNull(), 1).otherwise(0)) * PCT).alias("pct_unknown_gender"),
    )


def gender_counts(members: DataFrame) -> DataFrame:
    """Value counts of gender with a bucket for null."""
    return members.groupBy(F.coalesce(F.col("gender"), F.lit("unknown")).alias("gender")).agg(
        F.count(F.lit(1)).alias("n")
    )


def registrations_by_year(members: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """A9 + P9 + F9: registrations per year within [first_year, last_year]."""
    y = year_of_ymd(F.col("registration_init_time"))
    return (
        members.select(y.alias("reg_year"))
        .filter(F.col("reg_year").between(first_year, last_year))
        .groupBy("reg_year")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def equal_width_histogram(df: DataFrame, col: str, n_bins: int) -> DataFrame:
    """A10: ``n_bins`` equal-width bins over [min, max] of ``col``; last bin closed;
    empty bins kept (n = 0).

    min / max are one scalar subquery; the bin table is ``spark.range(n_bins)`` and the
    counts are aggregated per bin id, so only ``n_bins`` rows meet in the join.
    """
    x = F.col(col).cast("double")
    vals = df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
    stats = vals.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
    lo, hi = stats.getField("lo"), stats.getField("hi")
    width = hi - lo
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - lo) * n_bins / width).cast("int"), F.lit(n_bins - 1))
    )
    counts = vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    bins = spark.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    return (
        bins.join(counts, "bin", "left")
        .select(
            "bin",
            r6(lo + F.col("bin") * width / n_bins).alias("bin_lo"),
            r6(lo + (F.col("bin") + 1) * width / n_bins).alias("bin_hi"),
            F.coalesce(F.col("n"), F.lit(0)).alias("n"),
        )
        .filter(lo.isNotNull())
    )


def age_histogram(members: DataFrame, n_bins: int = 50) -> DataFrame:
    """A10 over valid ages only."""
    return equal_width_histogram(members.select(valid_age(F.col("bd")).alias("age")), "age", n_bins)
