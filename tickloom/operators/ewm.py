"""Exponentially weighted means over long series, without a sequential pass over a key.

y1 = x1 and yt = a*xt + (1-a)*y(t-1) with a = 2/(span+1). Each step is an affine map, so a
series can be cut into chunks:

1. rows are shuffled by (key, chunk) where a chunk is at most `CHUNK_STEPS` grid steps wide. Rows are
   unique per grid step, so a chunk holds at most that many rows and a hot key spreads over as
   many tasks as it has chunks. Inside a chunk a running sum gives each row's response to the
   chunk's own values ("local").
2. one small row per chunk (count, ends, last local) goes to its key, where a fold carries the
   mean from chunk to chunk, in blocks of `FOLD_BLOCK` chunks so that its work stays linear. The list
   length follows the calendar, not the row count.
3. the entry value of its chunk is joined back: y = local + (1-a)^(i-1) * entry.

Everything is built-in expressions. The same fold starts from stored values (`carry`), so an
incremental run equals a full run.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_STEPS = 2048
FOLD_BLOCK = 128
# (1-a)^-n of a chunk must stay far inside the double range, whatever the inputs are scaled to
LARGEST_POWER_OF_TEN = 270


@dataclass(frozen=True)
class Mean:
    """One mean to compute: of `value` itself, or of its rises or falls from row to row."""

    value: str
    span: float
    out: str
    of: str = "level"  # 'level' | 'rise' | 'fall'

    def __post_init__(self):
        if self.span <= 1:
            raise ValueError("span must be greater than 1 (a span of 1 is the value itself)")

    @property
    def longest_chunk(self) -> int:
        return max(1, int(LARGEST_POWER_OF_TEN / -math.log10(1.0 - 2.0 / (self.span + 1.0))))

    @property
    def alpha(self) -> str:
        return f"{2.0 / (self.span + 1.0)!r}D"

    @property
    def keep(self) -> str:
        return f"{1.0 - 2.0 / (self.span + 1.0)!r}D"

    def change(self, now: str, before: str) -> str:
        """Rise or fall from `before` to `now`, not below 0; NULL stays NULL."""
        move = f"{now} - {before}" if self.of == "rise" else f"{before} - {now}"
        return f"CASE WHEN {move} > 0 THEN {move} WHEN {move} IS NOT NULL THEN 0D END"


def ewm(
    df: DataFrame,
    key: str,
    ts: str,
    step_seconds: int,
    means: Sequence[Mean],
    carry: DataFrame | None = None,
) -> DataFrame:
    """Add one column per mean.

    `df` must hold one row per (key, grid step of `step_seconds`); more rows than steps in a chunk raise.
    A row with a NULL, NaN or infinite input is stepped over: it keeps its place and shows the mean before it
    (NULL where there is none yet), and the next value follows as if the row were not there.
    `carry` has one row per key: the last value of every input (`last_<value>`) and of every mean.
    A mean of rises or falls is NULL on the first row of a key, which has no predecessor.
    """
    values = list(dict.fromkeys(m.value for m in means))
    entries = _fold(_chunk_ends(df.select(key, ts, *values), key, ts, step_seconds, means), key, means, carry)
    rows = _with_local(df, key, ts, step_seconds, means).join(entries, [key, "__c"])

    def result(m: Mean) -> str:
        y = f"__l_{m.out} + pow({m.keep}, __i - 1) * __e_{m.out}"
        if m.of != "level":
            y = f"CASE WHEN NOT (__head AND __i = 1) THEN {y} END"
        return f"CASE WHEN __i = 0 THEN __b_{m.out} ELSE {y} END AS {m.out}"

    return rows.selectExpr(*[f"`{c}`" for c in df.columns], *[result(m) for m in means])


def _with_local(df: DataFrame, key: str, ts: str, step: int, means: Sequence[Mean]) -> DataFrame:
    """Chunk number, 1-based position in the chunk and each mean's response to the chunk's own values.

    The first row of a chunk is left out of the response; it enters through the entry value. Positions
    count the rows whose inputs are finite numbers (`__ok`); NaN is greater than infinity in SQL.
    """
    inside = f"(PARTITION BY {key}, __c ORDER BY {ts})"
    so_far = f"(PARTITION BY {key}, __c ORDER BY {ts} ROWS UNBOUNDED PRECEDING)"
    moves = [m for m in means if m.of != "level"]
    # the chunk is never NULL, so both uses of the shuffled rows plan the same exchange and share it
    steps = min(CHUNK_STEPS, *[m.longest_chunk for m in means])
    chunk = f"coalesce(floor(unix_seconds(CAST({ts} AS TIMESTAMP)) / {step * steps}), 0L) AS __c"
    values = list(dict.fromkeys(m.value for m in means))
    known = " AND ".join(f"coalesce(abs(CAST({v} AS DOUBLE)) < DOUBLE('Infinity'), false)" for v in values)
    fits = f"assert_true(row_number() OVER {inside} <= {steps}, 'more rows than grid steps: remove duplicates first')"
    placed = df.selectExpr("*", chunk, f"({known}) AS __ok").selectExpr(
        "*",
        f"CAST(count_if(__ok) OVER {so_far} AS DOUBLE) AS __i",
        f"{fits} AS __fits",
        *[f"lag(CASE WHEN __ok THEN {v} END) IGNORE NULLS OVER {inside} AS __p_{v}" for v in dict.fromkeys(m.value for m in moves)],
    ).where("__fits IS NULL").drop("__fits")
    if moves:
        placed = placed.selectExpr(
            "*", *[f"{m.change(m.value, f'__p_{m.value}')} AS __d_{m.out}" for m in moves]
        )

    def local(m: Mean) -> str:
        x = m.value if m.of == "level" else f"__d_{m.out}"
        total = f"sum(CASE WHEN __ok AND __i > 1 THEN {x} * pow({m.keep}, -__i) END) OVER {so_far}"
        return f"{m.alpha} * pow({m.keep}, __i) * coalesce({total}, 0D) AS __l_{m.out}"

    return placed.selectExpr("*", *[local(m) for m in means])


def _chunk_ends(df: DataFrame, key: str, ts: str, step: int, means: Sequence[Mean]) -> DataFrame:
    """One row per chunk: size, first and last inputs, last local responses."""
    values = dict.fromkeys(m.value for m in means)
    return _with_local(df, key, ts, step, means).groupBy(key, "__c").agg(
        F.max("__i").alias("n"),
        *[F.expr(f"max(CASE WHEN __ok AND __i = 1 THEN {v} END)").alias(f"first_{v}") for v in values],
        *[F.expr(f"max_by({v}, __i) FILTER (WHERE __ok)").alias(f"last_{v}") for v in values],
        *[F.max_by(f"__l_{m.out}", "__i").alias(f"local_{m.out}") for m in means],
        *[
            F.expr(f"max(CASE WHEN __ok AND __i = 2 THEN __d_{m.out} END)").alias(f"second_{m.out}")
            for m in means
            if m.of != "level"
        ],
    )


def _fold(ends: DataFrame, key: str, means: Sequence[Mean], carry: DataFrame | None) -> DataFrame:
    """Entry value of every mean for every chunk, by folding a key's chunk list in time order."""
    values = list(dict.fromkeys(m.value for m in means))
    state = [f"last_{v}" for v in values] + [m.out for m in means]
    summary = ", ".join(c for c in ends.columns if c != key)
    listed = ends.groupBy(key).agg(F.expr(f"array_sort(collect_list(struct({summary})))").alias("chunks"))
    if carry is None:
        listed = listed.selectExpr("*", *[f"CAST(NULL AS DOUBLE) AS __s_{c}" for c in state])
    else:
        stored = carry.selectExpr(key, *[f"CAST({c} AS DOUBLE) AS __s_{c}" for c in state])
        listed = listed.join(stored, key, "left")

    def entry(m: Mean) -> str:
        x = f"c.first_{m.value}" if m.of == "level" else m.change(f"c.first_{m.value}", f"s.last_{m.value}")
        seed = "" if m.of == "level" else f"WHEN s.last_{m.value} IS NULL THEN c.second_{m.out} "
        return (
            f"CASE {seed}WHEN s.{m.out} IS NULL THEN {x} ELSE {m.keep} * s.{m.out} + {m.alpha} * ({x}) END"
        )

    def after(m: Mean) -> str:
        """Mean after the chunk; a chunk without values leaves it."""
        return f"CASE WHEN c.n = 0 THEN s.{m.out} ELSE c.local_{m.out} + pow({m.keep}, c.n - 1) * ({entry(m)}) END"

    fields = "c: bigint, head: boolean, " + ", ".join(f"e_{m.out}: double, b_{m.out}: double" for m in means)
    none, nothing = f"CAST(array() AS array<struct<{fields}>>)", f"CAST(array() AS array<array<struct<{fields}>>>)"
    item = f"struct(c.__c AS c, s.last_{values[0]} IS NULL AS head, " + ", ".join(
        f"{entry(m)} AS e_{m.out}, s.{m.out} AS b_{m.out}" for m in means
    )
    moved = [f"coalesce(c.last_{v}, s.last_{v}) AS last_{v}" for v in values] + [f"{after(m)} AS {m.out}" for m in means]
    step = f"struct(concat(s.entries, array({item}))) AS entries, {', '.join(moved)})"
    # an inner fold lists the entries of a block, the outer one the blocks
    begin = f"struct({none} AS entries, " + ", ".join(f"t.{c} AS {c}" for c in state) + ")"
    inner = f"aggregate(block, {begin}, (s, c) -> {step})"
    outer = f"transform(array({inner}), r -> struct(concat(t.blocks, array(r.entries)) AS blocks, " + ", ".join(
        f"r.{c} AS {c}" for c in state
    ) + "))[0]"
    start = f"struct({nothing} AS blocks, " + ", ".join(f"__s_{c} AS {c}" for c in state) + ")"
    blocks = f"transform(sequence(0, (size(chunks) - 1) div {FOLD_BLOCK}), k -> slice(chunks, CAST(k * {FOLD_BLOCK} + 1 AS INT), {FOLD_BLOCK}))"
    one = listed.selectExpr(key, f"inline(aggregate({blocks}, {start}, (t, block) -> {outer}, t -> flatten(t.blocks)))")
    return one.selectExpr(
        key, "c AS __c", "head AS __head", *[f"e_{m.out} AS __e_{m.out}" for m in means], *[f"b_{m.out} AS __b_{m.out}" for m in means]
    )


def carry_of(df: DataFrame, key: str, ts: str, values: Sequence[str], means: Sequence[Mean]) -> DataFrame:
    """State to continue from: per key the last inputs that are finite numbers, and the last means, of a frame made by `ewm`."""
    finite = lambda v: F.abs(F.col(v).cast("double")) < float("inf")
    return df.groupBy(key).agg(
        *[F.max_by(v, F.when(finite(v), F.col(ts))).alias(f"last_{v}") for v in values],
        *[F.max_by(m.out, ts).alias(m.out) for m in means],
    )
