"""Queries that SQL can express against it."""

import duckdb
import pytest

from tickloom.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_reference_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(Q.ORACLES[name])
    names = [d[0] for d in cur.description]
    want = sorted(repr(sorted(zip(names, r, strict=True))) for r in cur.fetchall())
    assert sorted(repr(sorted(r.asDict().items())) for r in Q.QUERIES[name](spark, SF).collect()) == want
