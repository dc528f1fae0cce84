import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lapse.config import Windows
from lapse.functions.scalar import age_band, clip, tenure_days, valid_age, ymd_to_date
from lapse.operators import features as feat
from lapse.operators.modeltable import fit_category_map, fit_scaler

W = Windows(feature_cutoff=dt.date(2016, 12, 31), value_start=dt.date(2017, 1, 1), value_end=dt.date(2017, 2, 28),
            engagement_start=dt.date(2016, 12, 2), engagement_end=dt.date(2016, 12, 31))


def _txns(spark, rows):
    # rows: (user_key, txn_id, date, method, amount)
    return spark.createDataFrame(
        [(u, t, dt.datetime(d.year, d.month, d.day), d, 30, Decimal(str(amt)), 1, 0, m) for u, t, d, m, amt in rows],
        "user_key long, txn_id long, txn_ts timestamp_ntz, txn_date date, payment_plan_days int, "
        "actual_amount_paid decimal(18,2), is_auto_renew int, is_cancel int, payment_method_id int",
    )


def test_seconds_clip_fixture(spark):
    vals = [-5.0, 0.0, 86400.0, 90000.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.c for r in df.select(clip(F.col("x"), 0.0, 86400.0).alias("c")).collect()]
    assert got == [0.0, 0.0, 86400.0, 86400.0, 86400.0, 86400.0]


def test_bad_dates_and_negative_tenure(spark):
    df = spark.createDataFrame([(20001399,), (None,), (20170101,)], "r int")
    got = [r.t for r in df.select(tenure_days(ymd_to_date("r"), dt.date(2016, 12, 31)).alias("t")).collect()]
    assert got == [None, None, -1]


def test_age_cleaning_and_bands(spark):
    df = spark.createDataFrame([(0,), (1,), (100,), (101,), (None,)], "bd int")
    rows = df.select(valid_age(F.col("bd")).alias("v"), age_band(F.col("bd")).alias("b")).collect()
    assert [r.v for r in rows] == [None, 1, 100, None, None]
    assert [r.b for r in rows] == ["unknown", "1-17", "45-100", "unknown", "unknown"]


def test_latest_row_tie_and_cutoff_edges(spark):
    t = _txns(spark, [
        (1, 10, dt.date(2016, 12, 31), 3, 10.0),   # on the cutoff: a feature row
        (1, 11, dt.date(2016, 12, 31), 7, 20.0),   # same user and date: larger txn_id wins
        (1, 12, dt.date(2017, 1, 1), 9, 5.0),      # first target day
        (1, 13, dt.date(2017, 2, 28), 9, 6.0),     # last target day
        (1, 14, dt.date(2017, 3, 1), 9, 100.0),    # after the target window
        (2, 20, dt.date(2017, 1, 15), 4, 50.0),    # forward-only user
    ])
    prof = {r.user_key: r for r in feat.transaction_profile(t, W).collect()}
    assert prof[1].num_transactions == 2 and prof[1].payment_method_id == 7
    assert prof[1].ltv == pytest.approx(11.0)
    assert prof[1].avg_actual_amount_paid == pytest.approx(15.0)
    assert prof[2].num_transactions == 0 and prof[2].avg_actual_amount_paid is None and prof[2].ltv == 50.0
    logs = spark.createDataFrame([], "user_key long, log_ts timestamp_ntz, log_date date")
    audit = feat.leakage_audit(t, logs, W).first()
    assert audit.n_log_rows == 0 and audit.max_log_date is None
    assert audit.is_time_safe and audit.n_overlap == 0 and audit.max_feature_date == dt.date(2016, 12, 31)


def test_encoder_numeric_order_and_unknown(spark):
    train = spark.createDataFrame([(2, "b"), (10, "a"), (None, None)], "code int, g string")
    cmap = {(r.feature, r.value): (r.code, r.cardinality) for r in fit_category_map(train, ["code", "g"]).collect()}
    assert cmap[("code", "2")] == (0, 3) and cmap[("code", "10")] == (1, 3)
    assert cmap[("g", "a")] == (0, 3) and cmap[("g", "b")] == (1, 3)


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (9.0, 5.0)], "x double, c double")
    st = {r.feature: r for r in fit_scaler(df, ["x", "c"]).collect()}
    assert st["x"].std == pytest.approx(3.0822070, abs=1e-6)
    assert st["c"].std == 0.0
    from lapse.operators.modeltable import apply_scaler

    out = apply_scaler(df, {"c": (st["c"].mean, st["c"].std)}).select("c_scaled").distinct().collect()
    assert [r.c_scaled for r in out] == [0.0]
