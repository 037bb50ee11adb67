import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tests.llm.cases import counted
from tickloom.llm import turn_repair as T

ROWS = StructType([
    StructField("conv_id", LongType()), StructField("turn", IntegerType()), StructField("role", StringType()), StructField("text", StringType()),
    StructField("part", StringType()), StructField("block", StringType()), StructField("copies", StringType()), StructField("cost", StringType()),
])
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "b", "c", "d") for r in rows], ROWS)


def least(lattice):
    """Least (cost, audit) by going through the rows one state at a time."""
    after = {"-": "su", "s": "u", "u": "a", "a": "u"}

    def insert(states):
        for _ in range(2):
            for state, (c, e) in list(states.items()):
                for role in after[state]:
                    if role != "s":
                        states[role] = min(states.get(role, (1 << 60, "")), (c + 3, e + "I"))
        return states

    states = insert({"-": (0, "")})
    for initial, gone, truncated in lattice:
        new = {}
        for state, (c, e) in states.items():
            options = [(state, c + 4, e + "D")]
            if not gone:
                for role in after[state]:
                    if role == initial:
                        options.append((role, c + 3 * truncated, e + "K"))
                    elif role != "s":
                        options.append((role, c + 3 + 3 * truncated, e + "R"))
            for s, *way in options:
                new[s] = min(new.get(s, (1 << 60, "")), tuple(way))
        states = insert(new)
    return min(states[s] for s in "-a" if s in states)


def plain(rows):
    """COLUMNS of every conversation, by the rules as stated."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn, role if role is not None else " ", text if text is not None else " "))
    out = []
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0], r[1] or 0, r[2], r[3]))
        faults, lattice, said = [0, 0, 0], [], set()
        for _, _, role, text in held:
            body = re.sub(r"[\x20\x09-\x0D]", "", text)
            kind = 0 if not body else 1 if (role, text) in said else 2 if body[-1] not in ".!?" else None
            if kind is not None:
                faults[kind] += 1
            said.add((role, text))
            lattice.append((role[:1], kind in (0, 1), kind == 2))
        turns = [t for known, t, _, _ in held if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(lattice, lattice[1:], strict=False))
        cost, audit = least(lattice)
        lines, k = [], 0
        for e in audit:
            if e == "D":
                k += 1
                continue
            role, text = (held[k][2], held[k][3]) if e != "I" else ("", "")
            if e != "K":
                role = "assistant" if lines and lines[-1][0] == "u" else "user"
            k += e != "I"
            lines.append(f"{role}:{text}")
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return counted(out)


def some_rows(seed, n, conv):
    rng = random.Random(seed)
    texts = ["a.", "b", "c!", "", "  \n", "d? \t", "long " * 30, "é。", "x.\x85", None]
    return [(conv, rng.choice([None, *range(n)]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(texts) if rng.random() < 0.4 else f"t{k}" + rng.choice([".", "", "!"])) for k in range(n)]


def test_search_equals_plain_search():
    rng = random.Random(1)
    for _ in range(1500):
        lattice = [(rng.choice("suautx"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(1, 9))]
        assert T.search(lattice, "-", T.FINAL) == least(lattice)


@pytest.mark.parametrize("size", [256, 4, 1])
def test_blocks_equal_brute_force(spark, monkeypatch, size):
    """Odd rows, nulls, ties and copies; blocks of any length give the same repair."""
    monkeypatch.setattr(T, "BLOCK_ROWS", size)
    rows = [r for k in range(60) for r in some_rows(k, k % 13 + 1, k if k % 7 else None)]
    rows += some_rows(99, 90, 1000) + [(1001, 0, "user", "same.")] * 40 + [(1002, k, "user", "ok.") for k in range(50)] + [(1003, None, None, None)]
    rows += [(1004, 5, "user", "w " * 60000), (1004, 2**31 - 1, "assistant", "w " * 60000 + ".")]
    got = T.repair_conversations(frame(spark, rows)).select(COLUMNS).collect()
    assert counted(map(tuple, got)) == plain(rows)


def test_hot_conversation_is_cut(spark, monkeypatch):
    """A conversation with most rows lies on several tasks, one block or row of it at a time."""
    monkeypatch.setattr(T, "BLOCK_ROWS", 32)
    rng = random.Random(4)
    rows = [(7, k, rng.choice(["user", "assistant", "assistant"]), f"said {k}" + rng.choice([".", "."  , ""])) for k in range(3000)]
    rows += [r for k in range(20) for r in some_rows(k, 5, 100 + k)]
    df = frame(spark, rows)
    got = T.repair_conversations(df).select(COLUMNS).collect()
    assert counted(map(tuple, got)) == plain(rows)
    seen = []
    whole = T._blocks

    def kept(ready, key):
        out = whole(ready, key)
        seen.append(out.filter("conv_id = 7").agg({"part": "approx_count_distinct", "n": "max"}).first())
        return out

    monkeypatch.setattr(T, "_blocks", kept)
    T.repair_conversations(df)
    assert seen[0]["approx_count_distinct(part)"] >= 4 and seen[0]["max(n)"] <= 32


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def test_damaged_rows(spark):
    rows = [r for k in range(40) for r in some_rows(k, 3, k if k % 9 else None)] + [(k, k, "user", "x.") for k in range(2000, 2060)]
    left = plain_damage(rows)
    want = plain(left)
    empty = hashlib.sha256(b"").hexdigest()
    want += [repr((c, 0, 0, 0, 0, 0, 0, "", empty)) for c in {r[0] for r in rows} - {r[0] for r in left}]
    assert len(want) > len(plain(left))
    got = T.repair_damaged(frame(spark, rows)).select(COLUMNS).collect()
    assert counted(map(tuple, got)) == sorted(want)


def test_empty(spark):
    assert T.repair_conversations(frame(spark, [])).collect() == []
    assert T.repair_damaged(frame(spark, [])).collect() == []
