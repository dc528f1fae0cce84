import pytest
from pyspark.sql import functions as F

from lapse.operators import calibrate as cb


def test_isotonic_fixture_interpolates_and_clamps(spark):
    val = spark.createDataFrame([(0.1, 0), (0.1, 1), (0.3, 0), (0.5, 1), (0.6, 0), (0.9, 1)],
                                "score double, is_churn int")
    model = cb.isotonic_fit(val)
    test = spark.createDataFrame([(i, x) for i, x in enumerate([0.0, 0.2, 0.55, 0.7, 1.0])], "user_key long, score double")
    got = [r.p_iso for r in cb.isotonic_apply(model, test).orderBy("user_key").collect()]
    assert got == pytest.approx([1 / 3, 1 / 3, 0.5, 2 / 3, 1.0], abs=1e-6)


def test_isotonic_output_is_monotone(spark):
    val = spark.range(500).select((F.col("id") / 500.0).alias("score"),
                                  (F.hash("id") % 3 == 0).cast("int").alias("is_churn"))
    model = cb.isotonic_fit(val)
    test = spark.range(101).select(F.col("id").alias("user_key"), (F.col("id") / 100.0).alias("score"))
    p = [r.p_iso for r in cb.isotonic_apply(model, test).orderBy("score").collect()]
    assert all(a <= b + 1e-12 for a, b in zip(p, p[1:]))


def test_temperature_recovers_scale(spark):
    # labels drawn with P(y=1) = sigmoid(z / 2): the fitted temperature should be near 2
    import math
    import random

    rnd = random.Random(3)
    rows = []
    for i in range(4000):
        z = rnd.uniform(-6, 6)
        y = 1 if rnd.random() < 1 / (1 + math.exp(-z / 2)) else 0
        rows.append((1 / (1 + math.exp(-z)), y))
    val = spark.createDataFrame(rows, "score double, is_churn int")
    t = cb.temperature_fit(val)
    assert 1.6 < t < 2.5


def test_temperature_uninformative_is_infinite(spark):
    rows = [(0.9, 0), (0.8, 0), (0.2, 1), (0.1, 1)] * 10
    val = spark.createDataFrame(rows, "score double, is_churn int")
    t = cb.temperature_fit(val)
    assert t == float("inf")
    assert cb.temperature_apply(val, t).select(F.max("p_temp")).first()[0] == 0.5
