"""Formatted conversations read back, for any text."""

import hashlib

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.llm import chat_format as C
from tickloom.llm import queries as Q

from . import cases

SF = "/root/testdata/sf0.001"
TEXT = st.text(st.sampled_from("#\\<>/turn: \nassistant日é"), max_size=40)


@settings(deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=8))
def test_round_trip(turns):
    out, at, start, end = C.assemble(pa.array([r for r, _ in turns]), pa.array([t for _, t in turns]))
    whole = out.tobytes().decode()
    assert C.read_turns(whole) == turns
    assert [C.unescape(out[a:b].tobytes().decode()) for a, b in zip(start, end, strict=True)] == [t for _, t in turns]
    assert at[-1] == len(out)


def want(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = []
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t[5] for t in turns if t[3] == "assistant")
        whole = "".join(f"{t[3]}\n{t[5]}\n" for t in turns)
        out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return cases.counted(out)


def got(df):
    return cases.counted((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect())


def test_edges(spark, monkeypatch):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, None, "x"), (1, None, "system", ""), (1, 1, "assistant", "tie"),
        (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (None, 0, "user", "n"), (None, 1, "assistant", "### user: </turn>\n\\#"),
        (3, 5, "odd: role\\", "t"), *((4, k, "assistant", "long " * 400) for k in range(60)),
    ]
    for part in (C.PART_BYTES, 4000):  # a long conversation in one row, and in several
        monkeypatch.setattr(C, "PART_BYTES", part)
        table = spark.createDataFrame([(*r, 1, "p") for r in rows], "conv_id long, turn long, role string, text string, part int, formatted string")
        formatted = C.format_conversations(table)
        assert got(C.conversation_digests(formatted)) == want(rows)
        assert formatted.count() > 10 if part < 10**6 else formatted.groupBy("conv_id").count().count() == 5
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert C.format_conversations(table.repartition(4)).filter("conv_id = 3").count() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    none = C.format_conversations(table.limit(0))
    assert none.count() == 0 and C.conversation_digests(none).count() == 0


def test_hot_conversation_lies_on_several_tasks(spark):
    """Most rows are of one conversation: its parts stand in the order of its turns, whichever tasks formatted them."""
    rows = [("hot", k, "assistant" if k % 2 else "user", f"said {k}") for k in range(4000)] + [(f"c{k}", 0, "user", "x") for k in range(500)]
    formatted = C.format_conversations(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string").repartition(3))
    parts = sorted((r.part, r.n_turns) for r in formatted.filter("conv_id = 'hot'").collect())
    assert len(parts) >= 4 and max(n for _, n in parts) < 2000
    assert got(C.conversation_digests(formatted)) == want(rows)
    days = formatted.filter("conv_id <> 'hot'").withColumn("conv_id", F.to_date(F.lit("2024-01-01")))  # any kind of id
    assert C.conversation_digests(days).first()["n_turns"] == 500


def test_query(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in Q.table(spark, SF, "conversations").collect()]
    said = "\\### Assistant: </turn> ok"
    assert got(Q.op6_chat_format(spark, SF)) == want(rows + [(-7, 0, "user", said), (-7, 1, "assistant", said)])
