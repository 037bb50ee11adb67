"""Chat formatting by columnar byte assembly, with a loss mask, and the reader of the format.

A turn is `### role: text</turn>\n`. Inside texts and roles `\\` is doubled, `##` becomes `#\\#` and `</turn>` becomes
`<\\/turn>` (in roles `:` also `\\:`), so `###` and `</turn>` stand only where the template puts them; dropping each
escaping backslash gives the text again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrays import ragged, text_bytes

END = b"</turn>\n"
#: The role whose texts are learnt.
LEARNT = "assistant"
#: Bytes of formatted text in one row at most, beyond the turn that reaches it.
PART_BYTES = 8 << 20
_TURN = re.compile(r"### ((?:[^:\\]|\\.)*): (.*)", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)

FORMATTED = "part long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>"


def escape(column: pa.Array) -> pa.Array:
    """Texts with the template's control strings broken up; nulls become empty."""
    column = column.cast(pa.large_string()).fill_null("")
    for plain, safe in (("\\", "\\\\"), ("##", "#\\#"), ("</turn>", "<\\/turn>")):
        column = pc.replace_substring(column, plain, safe)
    return column


def unescape(text: str) -> str:
    """The text before `escape`."""
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns in one buffer, the n + 1 turn offsets, and where each turn's text starts and ends."""
    kinds = pc.dictionary_encode(roles.cast(pa.large_string()).fill_null(""))
    names = [f"### {n}: ".encode() for n in pc.replace_substring(escape(kinds.dictionary), ":", "\\:").to_pylist()]
    kind = kinds.indices.to_numpy(zero_copy_only=False)
    pool = np.frombuffer(b"".join(names), np.uint8)
    head_len = np.fromiter(map(len, names), np.int64, len(names))
    head_at = np.append(0, np.cumsum(head_len))[kind]
    head_len = head_len[kind]
    data, offsets = text_bytes(escape(texts))
    text_len = np.diff(offsets)
    turn = np.append(0, np.cumsum(head_len + text_len + len(END)))
    text_at = turn[:-1] + head_len
    out = np.empty(int(turn[-1]), np.uint8)
    out[ragged(turn[:-1], head_len)] = pool[ragged(head_at, head_len)]
    out[ragged(text_at, text_len)] = data
    out[(turn[1:] - len(END))[:, None] + np.arange(len(END))] = np.frombuffer(END, np.uint8)
    return out, turn, text_at, text_at + text_len


def format_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, part, n_turns, formatted, loss_starts and loss_ends: every conversation in the template.

    Turns stand in the order of `turn` (nulls first), equal turns by role and text, repeated rows as often as they
    occur. A null text is empty, a null role the empty role, a null conversation id a conversation of its own; an empty
    table gives no rows; other columns are ignored. loss_starts / loss_ends are byte ranges of the (escaped) assistant
    texts in `formatted`. A conversation is one row unless it is longer than 8 MB or stands where the rows of two tasks meet:
    it then goes on in rows with ascending `part`. Rows are dealt by ranges of conversation, turn and role, so one with most
    of the rows is formatted by several tasks, which hold a few megabytes of it at a time.
    """
    source = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() << 32  # tasks are in the order of ranges
        open_, part = None, task  # the conversation whose rows may go on in the next batch
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            conv = batch.column(0).to_pylist()
            out, turn, start, end = assemble(batch.column(2), batch.column(3))
            learnt = pc.fill_null(pc.equal(batch.column(2), LEARNT), False).to_numpy(zero_copy_only=False)
            cut = [0]
            for k in range(1, n):
                if conv[k] != conv[k - 1] or turn[k] - turn[cut[-1]] >= PART_BYTES:
                    cut.append(k)
            numbers = []
            for k in cut:
                part = part + 1 if open_ == (conv[k],) else task
                open_ = (conv[k],)
                numbers.append(part)
            at = np.array(cut)
            after = np.append(at[1:], n)
            base = np.repeat(turn[at], after - at)[learnt]
            marks = np.append(0, np.cumsum(np.add.reduceat(learnt.astype(np.int64), at)))
            text = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(turn[np.append(at, n)].tobytes()), pa.py_buffer(out))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)), pa.array(numbers, pa.int64()), pa.array(after - at, pa.int64()),
                    text.cast(pa.string()),
                    pa.ListArray.from_arrays(pa.array(marks, pa.int32()), pa.array(start[learnt] - base, pa.int64())),
                    pa.ListArray.from_arrays(pa.array(marks, pa.int32()), pa.array(end[learnt] - base, pa.int64())),
                ],
                names=["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_ends"],
            )

    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = source.repartitionByRange(n, *order[:3]).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, f"conv_id {rows.schema[conv_col].dataType.simpleString()}, {FORMATTED}")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation or part of one."""
    return [tuple(map(unescape, _TURN.fullmatch(t).groups())) for t in formatted.split(END.decode())[:-1]]


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted text and its mask alone: turns and learnt texts as counts and hashes.

    conv_id, n_turns, turns_sha256 (of role, newline, text, newline per turn), loss_chars and loss_sha256 (code points
    and hash of the unescaped text under the mask), formatted_chars. Parts are folded in order, one at a time. Ids of
    any type that Arrow knows stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = (), None
        schema = pa.schema([("conv_id", formatted_id), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

        def done() -> dict:
            n, turns, chars, loss, total = state
            return dict(zip(schema.names, [conv[0], n, turns.hexdigest(), chars, loss.hexdigest(), total], strict=True))

        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if conv != (r["conv_id"],):
                    if state:
                        rows.append(done())
                    conv, state = (r["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(r["formatted"]):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                raw = r["formatted"].encode()
                for a, b in zip(r["loss_starts"], r["loss_ends"], strict=True):
                    text = unescape(raw[a:b].decode())
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(r["formatted"])
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if state:
            yield pa.RecordBatch.from_pylist([done()], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_type

    kind = formatted.schema["conv_id"].dataType
    formatted_id = to_arrow_type(kind)
    ordered = formatted.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part")
    return ordered.mapInArrow(
        run, f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
