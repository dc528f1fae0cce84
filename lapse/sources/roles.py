"""Role views: bind the driver tables to the four roles of the churn data model.

members  <- customer    (one row per user)
label    <- customer + orders (is_churn = no order from ``churn_from`` on)
transactions <- orders  (one row per payment)
logs     <- events      (one row per activity event, with completion counters)

Every view is a projection over one Parquet scan, so predicates on the raw columns
(``txn_ts``, ``log_ts``) reach the scan as ``PushedFilters``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.sources.tables import Reader, read_table

# ---- fixed values of the role binding (must match the oracle SQL) -------------------
GENDER_BY_SEGMENT = {              # c_mktsegment -> gender; FURNITURE (any other) -> null
    "AUTOMOBILE": "male",
    "MACHINERY": "male",
    "BUILDING": "female",
    "HOUSEHOLD": "female",
}
CHANNEL_MODULUS = 12               # registered_via = c_custkey % 12
CHURN_FROM = dt.date(2001, 1, 1)   # label 1 = no order on or after this date
COMPLETION_EVENT = {               # event type -> completion counter column
    "click": "num_25",
    "error": "num_50",
    "purchase": "num_75",
    "signup": "num_985",
    "view": "num_100",
}
# The events of the driver tables run 8,415 days after the payments: 2024-01-15 there is the cutoff
# 2000-12-31 here.  ``log_ts`` keeps the stored clock, so filters reach the scan; ``log_date`` is shifted.
LOG_CLOCK_DAYS = 8415
LOG_SOURCES = ["events_v2", "events"]  # the first that exists is read
# ---------------------------------------------------------------------------------------


def day_start(d: dt.date) -> Column:
    """Timestamp literal at 00:00 of ``d``, typed like the driver timestamps (NTZ).

    Built from text: a Python datetime literal would pass through the session time zone
    and move the boundary; a string cast to TIMESTAMP_NTZ is zone-free.
    """
    return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")


def ts_on_or_before(ts: Column, d: dt.date) -> Column:
    return ts < day_start(d + dt.timedelta(days=1))


def log_ts_between(ts: Column, lo: dt.date, hi: dt.date) -> Column:
    """``ts_between`` on the stored clock of the events."""
    clock = dt.timedelta(days=LOG_CLOCK_DAYS)
    return ts_between(ts, lo + clock, hi + clock)


def ts_between(ts: Column, lo: dt.date, hi: dt.date) -> Column:
    return (ts >= day_start(lo)) & ts_on_or_before(ts, hi)


def members(spark: SparkSession, root: str, read: Reader = read_table) -> DataFrame:
    c = read(spark, root, "customer")
    k = F.col("c_custkey")
    gender = F.lit(None).cast("string")
    for seg, g in reversed(list(GENDER_BY_SEGMENT.items())):
        gender = F.when(F.col("c_mktsegment") == seg, F.lit(g)).otherwise(gender)
    reg = F.lit(20000101) - 10000 * (k % 11) + 100 * (k % 12) + k % 28
    return c.select(
        k.alias("user_key"),
        F.col("c_nationkey").cast("int").alias("city"),
        F.floor(F.col("c_acctbal") / 100).cast("int").alias("bd"),
        gender.alias("gender"),
        (k % CHANNEL_MODULUS).cast("int").alias("registered_via"),
        reg.cast("int").alias("registration_init_time"),
    )


def transactions(spark: SparkSession, root: str, read: Reader = read_table) -> DataFrame:
    o = read(spark, root, "orders")
    return o.select(
        F.col("o_custkey").alias("user_key"),
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_orderdate").alias("txn_ts"),
        F.to_date("o_orderdate").alias("txn_date"),
        (30 * (1 + F.col("o_orderkey") % 4)).cast("int").alias("payment_plan_days"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("actual_amount_paid"),
        F.when(F.col("o_orderstatus") != "O", 1).otherwise(0).alias("is_auto_renew"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("is_cancel"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_method_id"),
    )


def labels(spark: SparkSession, root: str, churn_from: dt.date = CHURN_FROM, read: Reader = read_table) -> DataFrame:
    """One row per customer: ``is_churn`` = 1 when the customer has no order from ``churn_from`` on.

    Active keys are reduced to one row per user (map-side partial aggregate) before the
    join, so a user with a third of all orders still ships one row per map task.
    """
    users = read(spark, root, "customer").select(F.col("c_custkey").alias("user_key"))
    active = (
        read(spark, root, "orders")
        .filter(F.col("o_orderdate") >= day_start(churn_from))
        .groupBy(F.col("o_custkey").alias("user_key"))
        .agg(F.lit(1).alias("_active"))
    )
    return users.join(active, "user_key", "left").select(
        "user_key", F.when(F.col("_active").isNull(), 1).otherwise(0).alias("is_churn")
    )


def logs(spark: SparkSession, root: str, source: str = "events", read: Reader = read_table) -> DataFrame:
    e = read(spark, root, source)
    out = [
        F.col("user_id").alias("user_key"),
        F.col("ts").alias("log_ts"),
        F.date_sub(F.to_date("ts"), LOG_CLOCK_DAYS).alias("log_date"),
        ((F.col("value") - 1) * 1000).alias("total_secs"),
    ]
    for etype, name in COMPLETION_EVENT.items():
        out.append(F.when(F.col("event_type") == etype, 1).otherwise(0).alias(name))
    return e.select(*out)
