"""A user holding a third of all payments: results stay exact and the aggregate combines
map-side (partial HashAggregate before the exchange)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lapse.config import Windows
from lapse.operators import explore as ex
from lapse.operators import features as feat

W = Windows()


def _txns(spark, n=3000):
    rows = []
    for i in range(n):
        u = 0 if i % 3 == 0 else 1 + i % 97  # user 0 holds a third of the rows
        d = dt.date(2000, 1 + i % 12, 1 + i % 28)
        rows.append((u, i, dt.datetime(d.year, d.month, d.day), d, 30, Decimal("10.00"), i % 2, 0, i % 5))
    return spark.createDataFrame(
        rows, "user_key long, txn_id long, txn_ts timestamp_ntz, txn_date date, payment_plan_days int, "
              "actual_amount_paid decimal(18,2), is_auto_renew int, is_cancel int, payment_method_id int")


def test_hot_user_profile_exact_and_partial(spark):
    t = _txns(spark).repartition(8)
    prof = feat.transaction_profile(t, W)
    hot = prof.filter(F.col("user_key") == 0).first()
    assert hot.num_transactions == 1000
    assert hot.avg_actual_amount_paid == 10.0
    # latest date for user 0: max over (date, txn_id)
    rows = [r for r in t.filter(F.col("user_key") == 0).collect()]
    best = max(rows, key=lambda r: (r.txn_date, r.txn_id))
    assert hot.payment_method_id == best.payment_method_id
    plan = prof._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "SortAggregate" not in plan


def test_hot_user_latest_flags(spark):
    t = _txns(spark).repartition(8)
    label = spark.createDataFrame([(u, u % 2) for u in range(98)], "user_key long, is_churn int")
    got = ex.renew_cancel_signals(label, t).collect()
    assert sum(r.n for r in got) == 98
