
from conftest import SF01
from lapse.operators.ranking import RankPlan
from lapse.plans.context import Context


def test_split_disjoint_exhaustive_stratified(spark):
    c = Context(spark, SF01)
    s = c.split
    rows = s.groupBy("is_churn", "split").count().collect()
    by = {}
    for r in rows:
        by.setdefault(r.is_churn, {})[r.split] = r["count"]
    for label, parts in by.items():
        n = sum(parts.values())
        hold = (n * 30 + 99) // 100
        test = (hold * 50 + 99) // 100
        assert parts == {"train": n - hold, "val": hold - test, "test": test}
    assert s.count() == s.select("user_key").distinct().count() == c.label.count()


def test_split_independent_of_bucketing(spark):
    a = Context(spark, SF01).split
    b = Context(spark, SF01, plan=RankPlan(rows_per_bucket=50)).split
    assert a.join(b, ["user_key", "is_churn", "split"], "left_anti").count() == 0


def test_results_independent_of_shuffle_partitions(spark):
    import __spark_entry__ as E

    keys = ["user_base_table", "stratified_split", "priority_scores", "model_metrics"]
    seen = {}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 7, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            for k in keys:
                df = E.queries()[k](spark, SF01)
                rows = sorted(tuple(r) for r in df.collect())
                seen.setdefault(k, rows)
                assert rows == seen[k], (k, parts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_results_independent_of_session_time_zone(spark):
    import __spark_entry__ as E
    from conftest import SF001

    keys = ["user_base_table", "engagement_window", "leakage_audit"]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        base = {}
        for tz in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            for k in keys:
                rows = sorted(tuple(r) for r in E.queries()[k](spark, SF001).collect())
                assert base.setdefault(k, rows) == rows, (k, tz)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
