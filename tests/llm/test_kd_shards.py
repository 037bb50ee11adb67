"""Shards near equal in bytes, equal texts together, slots without gaps."""

import zlib
from collections import defaultdict

from tickloom.llm import kd_shards
from tickloom.llm import queries as Q

from . import cases


def verify(rows, got, shards):
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    by = defaultdict(list)
    for r in got:
        assert any(r.size == len(t.encode()) + 8 and r.text_crc32 == zlib.crc32(t.encode()) for t in texts[r.doc_id])
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by[r.shard].append(r)
    assert cases.counted(r.doc_id for r in got) == cases.counted(i for i, _ in rows)
    for members in by.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    groups = defaultdict(set)
    for r in got:
        groups[r.size, r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in groups.values())
    return [sum(r.size for r in by[k]) for k in range(shards)]


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.doc_id, r.text) for r in Q.table(spark, sf, "documents").collect()]
    sizes = verify(rows, Q.op4_kd_shards(spark, sf).collect(), 24)
    mean = sum(sizes) / 24
    longest = max(len((t or "").encode()) for _, t in rows)
    assert max(abs(s - mean) for s in sizes) <= max(0.01 * mean, longest)


def test_plan_is_native(spark):
    plan = kd_shards.shard_documents(Q.table(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_edges(spark):
    rows = cases.edge_rows() + [(200 + k, cases.prose(k, 40)) for k in range(60)]
    verify(rows, kd_shards.shard_documents(cases.documents(spark, rows), 7).collect(), 7)
    same = [(k, "copy") for k in range(30)]
    assert sorted(verify(same, kd_shards.shard_documents(cases.documents(spark, same), 3).collect(), 3)) == [0, 0, 360]
    plain = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert kd_shards.shard_documents(plain).count() == 2
    assert kd_shards.shard_documents(cases.empty(spark)).count() == 0
