"""The pipeline against its stages done plainly, on a small table, and on odd rows."""

import corpus_pipeline as P
from pyspark.sql import functions as F

from tickloom.llm import pieces, queries as Q, weak_quality

from . import cases
from .test_decontaminate import brute as contaminated
from .test_jaccard_join import brute as linked
from .test_suffix_dedup import Counter

SF = "/root/testdata/sf0.001"


def removed(rows, length):
    texts = [(i, t.encode()) for i, t in rows]
    count = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        if not t or not all(gone):
            out.append((i, bytes(b for b, g in zip(t, gone, strict=True) if not g).decode(errors="replace")))
    return out


def test_against_plain_stages(spark):
    docs = Q.table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    poor = {r.doc_id for r in weak_quality.classify(docs).filter("rejected").collect()}
    rows = sorted((i, t) for i, t in texts.items() if i not in poor)
    classes = {eval(x)[0]: eval(x)[2] for x in linked(rows)}  # noqa: S307
    rows = removed([(i, t) for i, t in rows if classes[i] == i], P.PASSAGE_BYTES)
    items = [(r.item_id, r.text) for r in Q.table(spark, SF, "benchmark").collect()]
    hit = {eval(x)[0] for x in contaminated(rows, items) if eval(x)[2]}  # noqa: S307
    want = {i: t for i, t in rows if i not in hit}
    got = P.run(spark, SF)
    decoded = {r.doc_id: r.text for r in pieces.decode_pieces(got, Q.public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert decoded == want


def test_stages_keep_columns(spark, tmp_path):
    docs = cases.documents(spark, cases.edge_rows())
    columns = docs.columns
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        if k < len(P.STAGES) - 1:
            assert out.columns == columns, name
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert docs.count() > 0


def test_empty(spark):
    docs = cases.empty(spark)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, None), (4, None), (None, "x y z"), (None, "x y z")]
    out = P.near_copies(spark, cases.documents(spark, rows), SF)
    assert cases.counted((r.doc_id, r.text) for r in out.collect()) == cases.counted([(1, "a b c d e f"), (3, None), (4, None), (None, "x y z")])
    assert out.filter(F.col("doc_id") == 2).count() == 0


def test_texts_under_one_id_stay(spark):
    """A near copy goes, but not the other text under its id; of near copies without ids one stays."""
    a, b, c, d = (cases.prose(k, 200) for k in (21, 22, 23, 24))
    rows = [
        (3, a), (7, a + " more"), (7, b), (8, b + " more"), (None, c), (None, c + " more"), (9, c + " else"), (None, d), (None, d), (10, d + " more"),
        (11, cases.prose(25, 200)), (11, cases.prose(26, 200)),
    ]
    out = [(r.doc_id, r.text) for r in P.near_copies(spark, cases.documents(spark, rows), SF).collect()]
    of_c = [r for r in out if r[1].startswith(c)]
    assert of_c in ([rows[4]], [rows[5]])
    assert cases.counted(r for r in out if r not in of_c) == cases.counted([(3, a), (7, b), (None, d), *rows[-2:]])


def test_short_words_are_a_passage(spark):
    """A passage of 51 short words goes from both texts."""
    words = [w[:3] for w in cases.prose(31, 400).split(" ") if len(w) >= 3][:51]
    passage = " ".join(words)
    assert len(words) == 51 and 200 <= len(passage.encode()) < 250
    rows = [(k, f"{cases.prose(40 + k, 60)} {passage} {cases.prose(50 + k, 60)}") for k in range(2)]
    out = {r.doc_id: r.text for r in P.repeated_passages(spark, cases.documents(spark, rows), SF).collect()}
    assert not any(passage in t for t in out.values()) and len(out) == 2
