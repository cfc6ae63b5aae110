"""Every query that has SQL gives the rows that DuckDB gives, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry_points
from bidloom.session import TABLES

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def text(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(round(v, 6)) if isinstance(v, float) else str(v)


def test_every_oracle_has_a_query():
    assert ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    cur = duck.execute(ORACLES[name])
    there = [d[0] for d in cur.description]
    assert sorted(there) == columns
    expected = sorted(tuple(text(r[there.index(c)]) for c in columns) for r in cur.fetchall())
    assert sorted(tuple(text(r[c]) for c in columns) for r in df.collect()) == expected


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() >= 0


def test_entry(spark):
    assert entry_points.entry(spark).count() == 100


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_joins_everything_with_everything(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["open_tenders"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_terminal,0)" in plan and "title_en" not in plan
    plan = QUERIES["p6_found"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(qty_raw)" in plan and "raw_row" not in plan
