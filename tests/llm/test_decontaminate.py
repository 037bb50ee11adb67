"""Wu-Manber search against every window of every item."""

import pytest

from tickloom.llm import decontaminate
from tickloom.llm import queries as Q

from . import cases

SF = "/root/testdata/sf0.001"


def brute(rows, items, window=10):
    patterns = {}
    for item, text in items:
        words = cases.low_words(text)
        m = min(window, len(words))
        for k in range(len(words) - m + 1 if m else 0):
            patterns.setdefault(tuple(words[k : k + m]), set()).update([] if item is None else [str(item)])
    out = []
    for i, text in rows:
        words, found = cases.low_words(text), set()
        hit = [False] * len(words)
        for m in {len(p) for p in patterns}:
            for k in range(len(words) - m + 1):
                owners = patterns.get(tuple(words[k : k + m]))
                if owners is not None:
                    found |= owners
                    hit[k : k + m] = [True] * m
        out.append((i, len(words), sum(hit), tuple(sorted(found))))
    return cases.counted(out)


def got(df):
    return cases.counted((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in df.collect())


@pytest.mark.parametrize("window", [1, 3, 10])
def test_edges(spark, monkeypatch, window):
    rows = cases.edge_rows()
    words = (rows[18][1] or "").split(" ")
    items = [(1, " ".join(words[5:40])), (2, " ".join(words[30:36])), (10, "One TWO"), (10, "one, two"), (3, None), (4, ""), (5, "a"), (None, "a b")]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 64)  # several passes
    found = decontaminate.scan_contamination(
        cases.documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), window
    )
    assert got(found) == brute(rows, items, window)


def test_passes_add_up(spark, monkeypatch):
    """Spans and items of many blocks are those of one block; columns are carried through all passes."""
    docs, items = Q.table(spark, SF, "documents"), Q.table(spark, SF, "benchmark")
    run = lambda: sorted(map(repr, decontaminate.scan_contamination(docs, items, carry=("doc_id", "text", "lang")).collect()))
    one, size = run(), items.selectExpr("sum(octet_length(text))").first()[0]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size // 6)
    stored = []
    store = decontaminate.WorkTables.store
    monkeypatch.setattr(decontaminate.WorkTables, "store", lambda self, df, name: stored.append(name) or store(self, df, name))
    assert run() == one
    assert len(stored) >= 5


def test_tables_are_built_once(monkeypatch):
    built = []
    monkeypatch.setattr(decontaminate, "build_patterns", lambda items, window: built.append(items) or [])
    block = type("Block", (), {"value": [("1", "a b")]})()
    for _ in range(100):
        decontaminate._patterns("app/1", block, 10)
    assert len(built) == 1
    decontaminate._patterns("app/2", block, 10)
    assert len(built) == 2 and len(decontaminate._BUILT) == 1


def test_items_without_id_hit(spark):
    docs = cases.documents(spark, [(1, "zz one two three four"), (2, "two three"), (3, "four five"), (4, "six")])
    items = spark.createDataFrame([(None, "two three"), (None, "four five"), (7, "One two")], "item_id long, text string")
    assert got(decontaminate.scan_contamination(docs, items)) == cases.counted([(1, 5, 3, ("7",)), (2, 2, 2, ()), (3, 2, 2, ()), (4, 1, 0, ())])


def test_spans(spark):
    docs = cases.documents(spark, [(1, "Zz one two three. four\nqq One two! three")])
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    (r,) = decontaminate.scan_contamination(docs, items).collect()
    text = "Zz one two three. four\nqq One two! three".encode()
    assert [text[s.start : s.end] for s in r.hit_spans] == [b"one two three", b"One two! three"]


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    rows = cases.edge_rows()
    assert got(decontaminate.scan_contamination(cases.documents(spark, rows), items)) == brute(rows, [])
    assert decontaminate.scan_contamination(cases.empty(spark), items).count() == 0


def test_query(spark):
    import hashlib

    rows = [(r.doc_id, r.text) for r in Q.table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in Q.table(spark, SF, "benchmark").collect()]
    want = {eval(r)[0]: eval(r)[1:] for r in brute(rows, items)}  # noqa: S307
    for r in Q.op1_wu_manber(spark, SF).collect():
        n, hit, found = want.pop(r.doc_id)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
    assert not want
