"""Values and sizes that must not change a result silently."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lapse.config import Windows
from lapse.functions.scalar import r6
from lapse.operators import calibrate as cb
from lapse.operators import features as feat
from lapse.operators import modeltable as mt
from lapse.session import is_local
from lapse.sources.roles import LOG_CLOCK_DAYS, members
from lapse.sources.store import materialize, release
from lapse.sources.tables import dataset_inventory


def test_r6_keeps_large_infinite_and_nan_values(spark):
    xs = [1e13, 9.3e12, math.inf, -math.inf, math.nan, None, 1.23456749, -1.5e-7, 9.1e9 + 0.25]
    got = [r.y for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i").select(r6("x").alias("y")).collect()]
    assert got[:4] == xs[:4] and math.isnan(got[4]) and got[5] is None
    assert got[6:] == [1.234567, -0.0, 9.1e9 + 0.25]


def test_logit_of_certain_scores(spark):
    df = spark.createDataFrame([(0, 0.0, 0), (1, 1.0, 1), (2, 0.7, 1), (3, 0.3, 0), (4, None, 0), (5, 0.6, 0), (6, 0.4, 1)], "user_key long, score double, is_churn int")
    out = {r.user_key: r.p_temp for r in cb.temperature_apply(df, cb.temperature_fit(df)).collect()}
    assert out[4] is None and all(out[k] is not None for k in (0, 1, 2, 3))
    assert out[0] < out[3] < out[2] < out[1]


def test_isotonic_fits_unrounded_scores(spark):
    val = spark.createDataFrame([(0.501, 0), (0.502, 0), (0.503, 1), (0.504, 1)], "score double, is_churn int")
    p = {r.score: r.p_iso for r in cb.isotonic_apply(cb.isotonic_fit(val), val).collect()}
    assert p == {0.501: 0.0, 0.502: 0.0, 0.503: 1.0, 0.504: 1.0}


def test_every_bigint_orders_payments(spark):
    day = dt.date(2000, 5, 1)
    ids = [-(2**63), -5, 0, 2**47, 2**63 - 1]
    rows = [(1, i, dt.datetime(2000, 5, 1), day, 30, 1, 0, 0, k) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "user_key long, txn_id long, txn_ts timestamp_ntz, txn_date date, payment_plan_days int, "
                                     "actual_amount_paid int, is_auto_renew int, is_cancel int, payment_method_id int")
    got = feat.latest_payment_method(df, Windows())
    assert got.first().payment_method_id == 4
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_codes_beyond_doubles_keep_their_order(spark):
    big = [2**53, 2**53 + 1, 2**53 + 2, 5, -7, 10]
    df = spark.createDataFrame([(x,) for x in big], "city long")
    m = {int(r.value): r.code for r in mt.fit_category_map(df, ["city"]).collect()}
    assert m == {x: i for i, x in enumerate(sorted(big))}
    enc = mt.apply_category_map(df.union(spark.createDataFrame([(99,), (None,)], "city long")), mt.fit_category_map(df, ["city"]), ["city"])
    assert sorted(r.city_enc for r in enc.collect()) == [0, 1, 2, 3, 4, 5, 6, 6]


def test_all_customers_are_members(spark):
    from conftest import SF001

    assert members(spark, SF001).count() == spark.read.parquet(f"{SF001}/customer.parquet").count()


def test_inventory_sees_appended_files(spark, tmp_path):
    path = f"{tmp_path}/region.parquet"
    spark.range(10).write.parquet(path)
    assert dataset_inventory(spark, str(tmp_path), ["region"]).first().n_rows == 10
    spark.range(5).write.mode("append").parquet(path)
    assert dataset_inventory(spark, str(tmp_path), ["region"]).first().n_rows == 15


def test_cluster_master_is_not_local():
    assert is_local("local") and is_local("local[*]")
    assert not any(map(is_local, ("local-cluster[2,1,1024]", "yarn", "spark://h:7077", "k8s://x")))


def test_release_deletes_stored_tables(spark):
    from lapse.sources import store

    df = materialize(spark.range(3), "t")
    path = store._PROCESS.paths[-1]
    assert df.count() == 3 and release(spark) >= 1
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_a_scope_deletes_its_own_tables_only(spark):
    from lapse.sources.store import scope

    mine = materialize(spark.range(3), "mine")
    with scope(spark) as outer:
        theirs = materialize(spark.range(4), "theirs")
        with scope(spark):
            materialize(spark.range(5), "inner")
        assert len(outer.paths) == 1 and theirs.count() == 4
    assert mine.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
        theirs.count()


def _payments(spark, late_date):
    rows = [(1, 1, dt.datetime(2000, 5, 1), dt.date(2000, 5, 1)), (1, 2, dt.datetime(2001, 1, 5), dt.date(2001, 1, 5)), (2, 3, dt.datetime(2000, 12, 1), late_date)]
    return spark.createDataFrame(rows, "user_key long, txn_id long, txn_ts timestamp_ntz, txn_date date")


def _events(spark, shift):
    at = dt.datetime(2000, 12, 30, 12) + dt.timedelta(days=LOG_CLOCK_DAYS)
    rows = [(1, at, at.date() - dt.timedelta(days=LOG_CLOCK_DAYS - shift))]
    return spark.createDataFrame(rows, "user_key long, log_ts timestamp_ntz, log_date date")


@pytest.mark.parametrize("late_date,shift,safe", [(dt.date(2000, 12, 1), 0, True), (dt.date(2001, 1, 2), 0, False), (dt.date(2000, 12, 1), 5, False)])
def test_audit_fails_on_a_late_row(spark, late_date, shift, safe):
    assert feat.leakage_audit(_payments(spark, late_date), _events(spark, shift), Windows()).first().is_time_safe is safe
