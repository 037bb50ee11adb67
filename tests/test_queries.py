"""Every registered query against its reference SQL, and the shape of its plan."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tickloom import plans

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_matches_reference_sql(spark, duck, name):
    df = plans.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(plans.oracles()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert banned not in plan


def test_every_query_has_reference_sql():
    assert set(plans.queries()) == set(plans.oracles())
    assert set(plans.queries()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns[0] == "symbol"
