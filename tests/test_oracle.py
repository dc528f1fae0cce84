"""Every registered query against its DuckDB SQL at sf0.001 (rows, names, type families, values)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from lapse.plans.queries import REGISTRY
from tools.oracle_check import TABLES, family, rows_of

KEYS = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF001)
    s_types = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields}
    s_rows = [r.asDict() for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(s_rows) > 0
        return
    rel = con.sql(sql)
    d_types = {n: family(str(t)) for n, t in zip(rel.columns, rel.types)}
    d_rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(s_types) == sorted(d_types)
    assert s_types == d_types
    cols = sorted(s_types)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_rows, cols, 6) == rows_of(d_rows, cols, 6)
