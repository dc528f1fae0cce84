"""Active days as bitmaps against a distinct count."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lapse.operators import explore as ex
from lapse.operators import features as feat
from lapse.operators.daybits import active_days, day_span
from lapse.plans.context import Context


def rows(n, span, seed):
    rng = random.Random(seed)
    first = dt.date(1999, 11, 30)
    out = [(0 if rng.random() < 0.33 else rng.randint(1, 20), first + dt.timedelta(days=rng.randrange(span)), float(i)) for i in range(n)]
    return first, out + [(5, None, 1.0), (77, None, 2.0), (5, first - dt.timedelta(days=1), 4.0), (5, first + dt.timedelta(days=span), 8.0)]


@pytest.mark.parametrize("span", [1, 15, 63, 64, 127, 400, 63 * 64, 63 * 64 + 1, 9000])
def test_days_equal_a_distinct_count(spark, span):
    first, data = rows(3000, span, span)
    df = spark.createDataFrame(data, "u long, day date, x double")
    last = first + dt.timedelta(days=span - 1)
    got = {r.u: (r.days, r.x) for r in active_days(df, "u", "day", (first, last), {"x": F.col("x")}, "days").collect()}
    want = {}
    for u, day, x in data:
        days, total = want.setdefault(u, (set(), 0.0))
        want[u] = (days | ({day} if day and first <= day <= last else set()), total + x)
    assert got == {u: (len(d), x) for u, (d, x) in want.items()}


def test_one_aggregate_level_and_one_shuffle(spark):
    c = Context(spark, SF001)
    for df in (feat.engagement_window(c.logs, c.w), ex.engagement_by_label(c.label.filter("false"), c.logs)):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        plan = buf.getvalue()
        assert "distinct" not in plan and "log_date" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    plan = feat.engagement_window(c.logs, c.w)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2


def test_no_logs_at_all(spark):
    c = Context(spark, SF001)
    none = c.logs.filter("false")
    assert day_span(none, "log_date") is None
    out = ex.engagement_by_label(c.label, none).collect()
    assert out and all(r.avg_active_days is None for r in out)
