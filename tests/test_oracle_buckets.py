"""Ranking-heavy queries on real data with many buckets forced: still equal to the oracle."""

import duckdb
import pytest

from conftest import SF01
from lapse.config import CHECKED
from lapse.operators.ranking import RankPlan
from lapse.plans.context import Context
from lapse.plans.oracle import SQL
from lapse.plans.queries import REGISTRY
from tools.oracle_check import TABLES, family, rows_of

KEYS = ["stratified_split", "median_imputation", "category_map", "split_profile", "hash_sample", "roc_points",
        "auc_by_model", "average_precision", "priority_scores", "segment_representatives", "budget_policies",
        "rank_sensitivity", "value_scatter_sample"]
PLAN = RankPlan(rows_per_bucket=60)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_many_buckets_match_oracle(spark, con, key):
    df = REGISTRY[key](Context(spark, SF01, CHECKED, PLAN))
    s_types = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields}
    s_rows = [r.asDict() for r in df.collect()]
    rel = con.sql(SQL[key])
    d_rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    cols = sorted(s_types)
    assert sorted(rel.columns) == cols
    assert rows_of(s_rows, cols, 6) == rows_of(d_rows, cols, 6)
