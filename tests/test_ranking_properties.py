"""Property test: bucketed positions and running sums equal a plain sort, for any data."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lapse.operators.ranking import RankPlan, ordered_running

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5).map(lambda x: x / 4), st.integers(0, 3)),
    min_size=1, max_size=120,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, rows_per_bucket=st.integers(1, 40), desc=st.booleans())
def test_positions_match_sorted(spark, rows, rows_per_bucket, desc):
    data = [(i, g, v, w) for i, (g, v, w) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, g string, v double, w long")
    got = ordered_running(df, "v", descending=desc, k="k", group=["g"], sums=["w"],
                          plan=RankPlan(rows_per_bucket=rows_per_bucket))
    res = {r.k: (r.pos, r.w_cum) for r in got.collect()}
    expect = {}
    for g in {d[1] for d in data}:
        part = sorted((d for d in data if d[1] == g), key=lambda d: ((-d[2] if desc else d[2]), d[0]))
        run = 0
        for pos, d in enumerate(part, start=1):
            run += d[3]
            expect[d[0]] = (pos, run)
    assert res == expect
