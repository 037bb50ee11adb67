"""Suffix arrays against sorting, and removed bytes against all strings of the corpus."""

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.llm import queries as Q
from tickloom.llm import suffix_dedup as S

from . import cases

SF = "/root/testdata/sf0.001"


def by_sorting(text):
    return sorted(range(len(text)), key=lambda i: text[i:])


@settings(deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_small_alphabet(text):
    assert S.suffix_array(text) == by_sorting(text)


@pytest.mark.parametrize("text", [[], [5], [1] * 200, [1, 2] * 100, list(range(100)), list(range(100, 0, -1)), [2, 1, 1] * 60])
def test_suffix_array_shapes(text):
    assert S.suffix_array(text) == by_sorting(text)


def test_suffix_array_random():
    rng = random.Random(7)
    for n in (500, 2000):
        text = [rng.randint(0, 40) for _ in range(n)] * 2
        assert S.suffix_array(text) == by_sorting(text)


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return cases.counted(out)


def got(df):
    return cases.counted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("crowded", [1, 96])
def test_edges(spark, monkeypatch, crowded):
    """With few contexts allowed, anchors go the way of crowded ones; results stay."""
    monkeypatch.setattr(S, "GROUP_CONTEXTS", crowded)
    rows = cases.edge_rows()
    assert got(S.remove_repeats(cases.documents(spark, rows))) == brute(rows, 400)


@pytest.mark.parametrize("length", [200, 400])
def test_many_contexts_of_one_anchor(spark, monkeypatch, length):
    """A passage in 500 texts that part at any byte before and behind it, at production settings; strings lie in several ranges."""
    monkeypatch.setattr(S, "RANGE_STRINGS", 5000)
    rng = random.Random(length)
    passage = cases.prose(71, 120)
    rows = []
    for k in range(500):
        a, b = rng.randint(0, 40), rng.randint(0, 40)
        rows.append((k, cases.prose(5000 + k, 12) + passage[a : len(passage) - b] + cases.prose(9000 + k, 12)))
    rows += [(600, rows[3][1]), (601, rows[3][1]), (3, rows[3][1])]
    docs = cases.documents(spark, rows).repartition(4)
    assert got(S.remove_repeats(docs, length)) == brute(rows, length)


@pytest.mark.parametrize("length", [S.SHORTEST - 1, S.LONGEST + 1])
def test_lengths_out_of_range(spark, length):
    with pytest.raises(ValueError, match="length must be"):
        S.remove_repeats(cases.empty(spark), length)


@pytest.mark.parametrize("length", [S.SHORTEST, S.LONGEST])
def test_shortest_and_longest(spark, length):
    shared = cases.prose(81, 400)
    rows = [(k, cases.prose(82 + k, 20) + shared[k * 3 :] + cases.prose(90 + k, 30)) for k in range(6)]
    assert got(S.remove_repeats(cases.documents(spark, rows), length)) == brute(rows, length)


def test_small_segments_and_arrays(spark, monkeypatch):
    """Texts cut in segments and contexts in many arrays give the same."""
    monkeypatch.setattr(S, "ARRAY_BLOCKS", 64)
    rng = random.Random(3)
    shared = [cases.prose(100 + k, 90) for k in range(4)]
    rows = [(k, " ".join(rng.choice([*shared, cases.prose(1000 + k * 7 + j, 60)]) for j in range(4))) for k in range(40)]
    want = brute(rows, 300)
    assert got(S.remove_repeats(cases.documents(spark, rows), 300)) == want


def test_segments():
    import numpy as np

    data = np.frombuffer(cases.prose(5, 3000).encode(), np.uint8)
    whole = [np.concatenate(x) for x in zip(*S.anchors(data, 400), strict=True)]
    S.SEGMENT_BITS, kept = 11, S.SEGMENT_BITS
    try:
        cut = [np.concatenate(x) for x in zip(*S.anchors(data, 400), strict=True)]
    finally:
        S.SEGMENT_BITS = kept
    for first, many in ((whole[2], whole[3]), (cut[2], cut[3])):
        assert first[0] == 0 and (first[1:] == first[:-1] + many[:-1]).all() and first[-1] + many[-1] == len(data) - 399


def test_empty(spark):
    assert S.remove_repeats(cases.empty(spark)).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in Q.table(spark, SF, "documents").collect()]
    assert got(Q.op2_suffix_dedup(spark, SF)) == brute(rows, 400)


def test_texts_of_one_id_and_one_short_hash(spark):
    """A repeated passage goes from its own text, not from another under the same id whose 32-bit hash is the same."""
    passage, other = cases.prose(61, 120), cases.prose(62, 60)
    many = spark.range(400000).withColumn("text", F.concat(F.col("id").cast("string"), F.when(F.col("id") % 2 == 0, passage).otherwise(other)))
    same = many.groupBy(F.hash("text")).agg(F.count("*").alias("n"), F.min_by("text", "id").alias("a"), F.max_by("text", "id").alias("b"))
    pair = next((r.a, r.b) for r in same.filter("n = 2").collect() if r.a.endswith(passage) != r.b.endswith(passage))
    rows = [(None, pair[0]), (None, pair[1]), (1, passage)]
    got = cases.counted((r.n_bytes, r.n_removed) for r in S.remove_repeats(cases.documents(spark, rows), 400).collect())
    assert len(passage.encode()) >= 400
    assert got == cases.counted((len(t.encode()), len(passage.encode()) if passage in t else 0) for _, t in rows)
