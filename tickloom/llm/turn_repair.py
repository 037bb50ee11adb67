"""Conversation structure repair: cheapest edits that make the roles `(s?(ua)+)?`, by bidirectional Dijkstra.

The edit lattice has a node for every row boundary and state: nothing yet, after a system, a user or an assistant row.
An edge keeps, re-roles or deletes the next row, or inserts one. A forward and a reverse heap meet in the middle; once no
cheaper crossing is possible, all crossings of equal cost are finished and the least audit of them is taken.

A long conversation is cut into blocks of rows that lie on several tasks. A block is searched from every state it may be
entered in to every state it may be left in; a light fold over the blocks then picks the states between them, comparing
audits only back to where they part. So no task holds a whole conversation's texts.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.work import WorkTables

#: Rows and bytes of text of a block at most (one longer row makes a longer block).
BLOCK_ROWS, BLOCK_BYTES = 256, 1 << 20
#: Costs of edits; a truncated row that stays costs KEEP_TRUNCATED besides.
REROLE, DELETE, INSERT, KEEP_TRUNCATED = 3, 4, 3, 3
#: States, named by the initial of the last row; `-` before any row.
STATES = "-sua"
#: A conversation may end in these.
FINAL = "-a"
#: State -> initials of the roles that may follow it.
_NEXT = {"-": "su", "s": "u", "u": "a", "a": "u"}
_ADDED = {"u": "user", "a": "assistant"}
_BLANK = "\x20\x09\x0a\x0b\x0c\x0d"

Edge = tuple[int, str, tuple[int, str]]


def edits(k: int, state: str, rows: list[tuple[str, bool, bool]]) -> Iterator[Edge]:
    """Cost, audit letter and target of every edit at boundary k; rows are (initial, must go, truncated)."""
    for role in _NEXT[state]:
        if role in _ADDED:
            yield INSERT, "I", (k, role)
    if k == len(rows):
        return
    initial, gone, truncated = rows[k]
    yield DELETE, "D", (k + 1, state)
    if not gone:
        extra = KEEP_TRUNCATED if truncated else 0
        for role in _NEXT[state]:
            if role == initial:
                yield extra, "K", (k + 1, role)
            elif role in _ADDED:
                yield REROLE + extra, "R", (k + 1, role)


def search(rows: list[tuple[str, bool, bool]], entry: str, exits: str) -> tuple[int, str] | None:
    """Least cost and, of the audits of that cost, the ASCII-least, from `entry` before the rows to one of `exits` after them."""
    into: dict[tuple[int, str], list[Edge]] = {}

    def edges_into(k: int) -> None:
        """Edges that end at boundary k, by target."""
        for before in (k, k - 1):
            for state in STATES if before >= 0 else ():
                for cost, letter, target in edits(before, state, rows):
                    if target[0] == k:
                        into.setdefault(target, []).append((cost, letter, (before, state)))

    source = (0, entry)
    best = {1: {source: (0, "")}, -1: {(len(rows), s): (0, "") for s in exits}}
    heaps = {1: [(0, 0, entry)], -1: [(0, -len(rows), s) for s in exits]}
    done: dict[int, set] = {1: set(), -1: set()}
    seen: set[int] = set()
    least = 0 if source in best[-1] else float("inf")
    while heaps[1] and heaps[-1] and heaps[1][0][0] + heaps[-1][0][0] <= least:
        way = 1 if heaps[1][0][0] <= heaps[-1][0][0] else -1
        cost, k, state = heapq.heappop(heaps[way])
        node = (k * way, state)
        if node in done[way]:
            continue
        done[way].add(node)
        if way == -1 and node[0] not in seen:
            seen.add(node[0])
            edges_into(node[0])
        audit = best[way][node][1]
        for step, letter, other in edits(*node, rows) if way == 1 else into.get(node, ()):
            # edges of no cost lead to the next row, so of equal costs the nearer boundary comes first on either heap
            label = (cost + step, audit + letter if way == 1 else letter + audit)
            if label < best[way].get(other, (float("inf"), "")):
                best[way][other] = label
                heapq.heappush(heaps[way], (label[0], other[0] * way, other[1]))
            if other in best[-way]:
                least = min(least, label[0] + best[-way][other][0])
    if least == float("inf"):
        return None
    audits = [best[1][n][1] + best[-1][n][1] for n in done[1] | {source} if n in best[-1] and best[1][n][0] + best[-1][n][0] == least]
    for node in done[1]:  # crossings: one end reached from the front, the other from the back
        cost, audit = best[1][node]
        audits += [audit + letter + best[-1][other][1] for step, letter, other in edits(*node, rows) if other in best[-1] and cost + step + best[-1][other][0] == least]
    return least, min(audits)


def replay(rows: list[tuple[str, str]], entry: str, audit: str) -> list[str]:
    """`role:text` of what the edits leave."""
    out, state, k = [], entry, 0
    for letter in audit:
        if letter == "D":
            k += 1
            continue
        role, text = rows[k] if letter != "I" else ("", "")
        if letter == "K":
            state = role[:1]
        else:
            state = next(r for r in _NEXT[state] if r in _ADDED)
            role = _ADDED[state]
        out.append(f"{role}:{text}")
        k += letter != "I"
    return out


def _cut(batches: Iterator[pa.RecordBatch], most_rows: int, most_bytes: int) -> Iterator[tuple[list, bool, bool]]:
    """Blocks of the rows of one conversation, and whether the task has seen the rows before and after it, so that it starts or ends one."""
    block, size, opens, last = [], 0, False, ()
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            changed = bool(last) and last[0] != row[0]
            if block and (changed or len(block) >= most_rows or size + len(row[3]) > most_bytes):
                yield block, opens, changed
                block, size, opens = [], 0, changed
            block.append(row)
            size += len(row[3])
            last = row
    if block:
        yield block, opens, False


def _blocks(rows: DataFrame, key: str) -> DataFrame:
    """One row per block from sorted rows (conv_id, turn, role, text, repeated): counts, both ends, and the searches (entry, exit, cost, audit)."""
    schema = f"conv_id {key}, part int, block int, n int, blank long, duplicate long, truncated long, illegal long, gaps long, first string, last string, low long, high long, found array<struct<entry: string, exit: string, cost: long, audit: string>>, roles array<string>, texts array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for number, (block, opens, closes) in enumerate(_cut(batches, BLOCK_ROWS, BLOCK_BYTES)):
            faults, lattice = {"blank": 0, "duplicate": 0, "truncated": 0}, []
            for _, _, role, text, repeated in block:
                words = text.rstrip(_BLANK)
                fault = "blank" if not words else "duplicate" if repeated else "truncated" if words[-1] not in ".!?" else None
                if fault:
                    faults[fault] += 1
                lattice.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
            found = []
            for entry in "-" if opens else STATES:
                for exits in [FINAL] if closes else STATES:
                    if (way := search(lattice, entry, exits)) is not None:
                        found.append({"entry": entry, "exit": exits, "cost": way[0], "audit": way[1]})
            turns = [t for _, t, _, _, _ in block if t is not None]
            pairs = zip(lattice, lattice[1:], strict=False)
            yield pa.RecordBatch.from_pylist([{
                "conv_id": block[0][0], "part": part, "block": number, "n": len(block), **faults, "illegal": sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in pairs),
                "gaps": sum(max(0, b - a - 1) for a, b in zip(turns, turns[1:], strict=False)), "first": lattice[0][0], "last": lattice[-1][0],
                "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "found": found,
                "roles": [r[2] for r in block], "texts": [r[3] for r in block],
            }], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return rows.mapInArrow(run, schema)


class _Way:
    """Audits of a chain of blocks, sharing their beginnings."""

    __slots__ = ("audit", "before", "entry")

    def __init__(self, before: _Way | None, entry: str, audit: str):
        self.before, self.entry, self.audit = before, entry, audit

    def less(self, other: _Way) -> bool:
        """Whether this audit is the lesser one of two over the same blocks."""
        a, b, mine, others = self, other, [], []
        while a is not b:
            mine.append(a.audit)
            others.append(b.audit)
            a, b = a.before, b.before
        return "".join(reversed(mine)) < "".join(reversed(others))


def _folded(blocks: DataFrame, key: str) -> DataFrame:
    """Per block, in order: the state it is entered in and its audit; with the last one the totals of the conversation."""
    numbers = ("blank", "duplicate", "truncated", "illegal", "gaps")
    schema = f"conv_id {key}, part int, block int, entry string, audit string, is_last boolean, cost long, " + ", ".join(f"{n} long" for n in numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[tuple] = []
        ways: dict[str, tuple[int, _Way | None]] = {}
        totals = dict.fromkeys(numbers, 0)
        ends: tuple = ("", None)

        def close() -> Iterator[pa.RecordBatch]:
            cost, way = None, None
            for state in [s for s in (FINAL, *FINAL) if s in ways]:
                here = ways[state]
                if way is None or here[0] < cost or here[0] == cost and here[1].less(way):
                    cost, way = here
            chosen = []
            while way is not None:
                chosen.append((way.entry, way.audit))
                way = way.before
            rows = [
                {"conv_id": n[0], "part": n[1], "block": n[2], "entry": e, "audit": a, "is_last": False}
                for n, (e, a) in zip(names, reversed(chosen), strict=True)
            ]
            rows[-1] |= {"is_last": True, "cost": cost, **totals}
            for k in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_pylist(rows[k : k + 4096], schema=arrow)

        for batch in batches:
            for row in batch.to_pylist():
                if names and names[0][0] != row["conv_id"]:
                    yield from close()
                    names = []
                if not names:
                    ways, totals, ends = {"-": (0, None)}, dict.fromkeys(numbers, 0), ("", None)
                names.append((row["conv_id"], row["part"], row["block"]))
                for n in numbers:
                    totals[n] += row[n]
                totals["illegal"] += len(names) > 1 and ends[0] + row["first"] not in ("su", "ua", "au")
                if row["low"] is not None:
                    totals["gaps"] += 0 if ends[1] is None else max(0, row["low"] - ends[1] - 1)
                ends = (row["last"], row["high"] if row["high"] is not None else ends[1])
                after: dict[str, tuple[int, _Way]] = {}
                for found in row["found"]:
                    if (start := ways.get(found["entry"])) is None:
                        continue
                    cost, way = start[0] + found["cost"], _Way(start[1], found["entry"], found["audit"])
                    have = after.get(found["exit"])
                    if have is None or cost < have[0] or cost == have[0] and way.less(have[1]):
                        after[found["exit"]] = (cost, way)
                ways = after
        if names:
            yield from close()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    order = [F.col("conv_id").asc_nulls_first(), "part", "block"]
    light = blocks.select("conv_id", "part", "block", "first", "last", "low", "high", "found", *numbers)
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return light.repartition(n, "conv_id").sortWithinPartitions(*order).mapInArrow(run, schema)


def _digests(blocks: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """conv_id, audit and repaired_sha256. Blocks are replayed where they lie; only their outcome is put in order."""

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                lines = replay(list(zip(row["roles"], row["texts"], strict=True)), row["entry"], row["audit"])
                body = {"conv_id": row["conv_id"], "part": row["part"], "block": row["block"], "audit": row["audit"], "lines": "\n".join(lines) if lines else None}
                yield pa.RecordBatch.from_pylist([body], schema=arrow)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audits, digest, begun = (), [], None, False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if conv != (row["conv_id"],):
                    if conv:
                        out.append({"conv_id": conv[0], "audit": "".join(audits), "repaired_sha256": digest.hexdigest()})
                    conv, audits, digest, begun = (row["conv_id"],), [], hashlib.sha256(), False
                audits.append(row["audit"])
                if row["lines"] is not None:
                    digest.update((("\n" if begun else "") + row["lines"]).encode())
                    begun = True
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=last)
        if conv:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv[0], "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}], schema=last)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    middle, end = f"conv_id {key}, part int, block int, audit string, lines string", f"conv_id {key}, audit string, repaired_sha256 string"
    arrow, last = (to_arrow_schema(StructType.fromDDL(x)) for x in (middle, end))
    joined = blocks.select("conv_id", "part", "block", "roles", "texts").join(chosen.select("part", "block", "entry", "audit"), ["part", "block"])
    lines = joined.select("conv_id", "part", "block", "entry", "audit", "roles", "texts").mapInArrow(rendered, middle)
    order = [F.col("conv_id").asc_nulls_first(), "part", "block"]
    return lines.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(folded, end)


def repair_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation in `rows`.

    Rows are taken by turn (nulls first), equal turns by role and text. The first fault of a row counts: blank (nothing
    but `[\\x20\\x09-\\x0D]`), duplicate (role and text stood in an earlier row), truncated (its last other character is not
    `[.!?]`). illegal counts neighbours whose role initials are not su, ua or au; gaps the turns missing between the
    first and the last. Keeping a row is free, re-roling it to user or assistant costs 3, deleting it 4 (blank and duplicate
    rows must go), inserting an empty user or assistant row 3, keeping a truncated row, re-roled or not, 3 more. audit
    has the initials of the cheapest edits (K, R, D, I) that leave role initials `(s?(ua)+)?`, the ASCII-least of equally
    cheap ones; repaired_sha256 hashes the lines `role:text` that they leave. A null role or text counts as one space, a null id
    is a conversation of its own; repeated rows are duplicates; an empty table gives no rows; other columns are ignored.
    """
    work = WorkTables(rows.sparkSession, "repair")
    key = rows.schema[conv_col].dataType.simpleString()
    named = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), *(F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text")))
    )
    # rows that repeat one another wholly are counted before they meet, and the first place of each role and text is found by a sum
    once = work.store(named.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")), "rows")
    where = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    said = once.groupBy("conv_id", "role", "text").agg(F.min(where).alias("first"), F.count("*").alias("times")).filter("times > 1")
    said = work.store(said.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("text").alias("_t"), "first"), "repeated")
    again = once.join(said, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("text") == F.col("_t")), "left")
    later = F.coalesce(where > F.col("first"), F.lit(False))
    marked = again.select("conv_id", "turn", "role", "text", "copies", later.alias("later"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges go by the beginning of a text, as Spark samples their bounds; copies are told apart once they are in place
    ordered = marked.repartitionByRange(n, *order[:3], F.left("text", F.lit(64))).sortWithinPartitions(*order)
    copied = ordered.select("conv_id", "turn", "role", "text", "later", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    ready = copied.select("conv_id", "turn", "role", "text", (F.col("later") | (F.col("copy") > 1)).alias("repeated"))
    blocks = work.store(_blocks(ready, key), "blocks")
    chosen = work.store(_folded(blocks, key), "chosen")
    digests = work.store(_digests(blocks, chosen, key), "digests")
    totals = work.store(chosen.filter("is_last").drop("part", "block", "entry", "audit", "is_last"), "totals")
    work.drop(digests, totals)
    found = totals.withColumnRenamed("conv_id", "_id").join(digests, F.col("_id").eqNullSafe(F.col("conv_id")))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults by crc32 of `conv_id:turn` modulo 20 (nulls: one space): 0 drops the row, 1 empties its text, 2 takes
    `[.!?]` out of it, 3 repeats it, 4 makes its role user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    hit = rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return hit.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy")


def repair_damaged(rows: DataFrame) -> DataFrame:
    """`repair_conversations` of the damaged rows, for every conversation of the undamaged ones; with no rows left: zeros and nothing repaired."""
    ids = rows.select(F.col("conv_id").alias("_id")).distinct()
    fixed = repair_conversations(damaged(rows))
    joined = ids.join(fixed, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select(F.col("_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
