"""Links and classes against all pairs."""

import random
from collections import Counter, defaultdict

import pytest

from tickloom.llm import jaccard_join as J
from tickloom.llm import queries as Q

from . import cases


def brute(rows):
    """(n_links, class, copies' least id) of every row, rows in order; ids may repeat."""
    sets = []
    for _, t in rows:
        w = cases.low_words(t)
        m = min(5, len(w))
        sets.append(frozenset(tuple(w[k : k + m]) for k in range(len(w) - m + 1)) if m else frozenset())
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, s in enumerate(sets):
        for other, common in Counter(o for x in s for o in holders[x] if o > k).items():
            if 5 * common >= 4 * (len(s) + len(sets[other]) - common):
                links[k] += 1
                links[other] += 1
                parent[find(other)] = find(k)
    groups = defaultdict(set)
    for k in range(len(rows)):
        groups[find(k)].add(rows[k][0])
    low = lambda ids: min(ids, key=lambda i: (i is not None, i or 0))
    return cases.counted((rows[k][0], links[k], low(groups[find(k)])) for k in range(len(rows)))


def got(df):
    return cases.counted((r.doc_id, r.n_links, r.class_id) for r in df.collect())


def crowd(n, seed=11):
    """Near copies of one text, most of them similar to each other, among texts that share a passage with them."""
    rng = random.Random(seed)
    base, passage = cases.prose(seed, 150).split(" "), cases.prose(seed + 1, 60)
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        rows.append((k, " ".join(words) + " " + passage))
    return rows + [(n + k, cases.prose(5000 + k, 200) + " " + passage) for k in range(n)]


@pytest.mark.parametrize(("small", "chunk"), [(64, 512), (4, 16)])
def test_crowds(spark, monkeypatch, small, chunk):
    monkeypatch.setattr(J, "SMALL", small)
    monkeypatch.setattr(J, "CHUNK", chunk)
    rows = crowd(60)
    want, have = brute(rows), got(J.jaccard_join(cases.documents(spark, rows)))
    missed = sum(eval(a)[1] - eval(b)[1] for a, b in zip(want, have, strict=True))  # noqa: S307
    assert 0 <= missed <= 0.005 * sum(eval(a)[1] for a in want)  # noqa: S307
    assert [eval(a)[2] for a in want] == [eval(b)[2] for b in have]  # noqa: S307


def test_edges(spark):
    rows = [r for r in cases.edge_rows() if r != (3, "other text under a used id")]
    assert got(J.jaccard_join(cases.documents(spark, rows))) == brute(rows)


def test_used_id_and_empty(spark):
    rows = cases.edge_rows()
    assert J.jaccard_join(cases.documents(spark, rows)).count() == len(rows)
    assert J.jaccard_join(cases.empty(spark)).count() == 0
    only = spark.createDataFrame([(1, None), (2, ""), (3, "!!")], "doc_id long, text string")
    assert got(J.jaccard_join(only)) == cases.counted([(1, 0, 1), (2, 0, 2), (3, 0, 3)])


def test_used_and_null_ids(spark):
    """Texts under one id, or without one, are linked by their words alone."""
    a, b, c, d = (cases.prose(k, 200) for k in (21, 22, 23, 24))
    changed = lambda t, k: t + f" more{k}"
    rows = [
        *cases.edge_rows(), (103, a), (107, changed(a, 1)), (107, b), (109, changed(b, 1)), (None, c), (None, changed(c, 1)), (111, changed(c, 2)),
        (None, d), (112, changed(d, 1)), (113, cases.prose(25, 200)), (113, cases.prose(26, 200)), (114, a.upper()), (None, "!"), (None, ""),
    ]
    assert got(J.jaccard_join(cases.documents(spark, rows))) == brute(rows)


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(50, 60), (70, 60), (5, 5)]
    found = {r.node: r.root for r in J.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(1, 31)}, 60: 50, 70: 50}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in Q.table(spark, sf, "documents").collect()]
    assert got(Q.op5_chosen_path_join(spark, sf)) == brute(rows)
