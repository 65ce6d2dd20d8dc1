"""Driver contract and plan-shape checks over every registered query:
entry runs, every query has an oracle, results equal the SQL oracle on the
smallest scale, and no plan has a cartesian product, a nested-loop join or a
Python UDF."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from quarry.plans import registry
from quarry.session import TABLES

SMALL = "/root/testdata/sf0.001"
BAD_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["y", "ECONOMY", "SMALL", "Other"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle_and_plan(spark, duck, name):
    df = registry.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in BAD_NODES:
        assert node not in plan, f"{name}: {node} in plan"
    cols = sorted(df.columns)
    srows = _rows([r.asDict() for r in df.collect()], cols)
    cur = duck.execute(registry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    drows = _rows([dict(zip(dcols, r)) for r in cur.fetchall()], cols)
    assert srows == drows
