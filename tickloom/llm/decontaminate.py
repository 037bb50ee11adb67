"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of `window` consecutive words of the benchmark items. A shift table over blocks of two words
tells how far no pattern can end, so most words are never looked at; where the shift is zero, buckets keyed by the hashes
of a pattern's last and first block select the patterns to test, and comparing all words, then their bytes, confirms
them. Many stretches of text are searched in step, as lanes of one numpy loop.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tickloom.llm.arrays import U64, carried, carried_columns, carried_field, mix, ragged, slices, text_bytes, words
from tickloom.llm.work import WorkTables

#: Benchmark bytes that are broadcast, and searched for, in one pass over the documents.
BLOCK_BYTES = 16 << 20
#: Words of one lane.
LANE = 512
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class Patterns:
    """Shift table and buckets of all patterns of one length in words."""

    def __init__(self, hashes: np.ndarray, texts: list[bytes], items: list[list[str]]):
        self.hashes, self.texts, self.items = hashes, texts, items  # (patterns, words); joined words; owners
        n, self.length = hashes.shape
        self.block = min(2, self.length)
        places = self.length - self.block + 1
        self.mask = (1 << max(12, (8 * n * places).bit_length())) - 1
        self.shift = np.full(self.mask + 1, places, np.int64)
        for j in range(places):
            np.minimum.at(self.shift, self._slot(self._blocks(hashes, j)), places - 1 - j)
        key = self._key(self._blocks(hashes, places - 1), self._blocks(hashes, 0))
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]

    def _blocks(self, table: np.ndarray, j: int) -> np.ndarray:
        return self._block(table[:, j], table[:, j + self.block - 1])

    def _block(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix(first * U64(0xD6E8FEB86659FD93) + last) if self.block == 2 else first

    def _slot(self, block: np.ndarray) -> np.ndarray:
        return (block & U64(self.mask)).astype(np.int64)

    @staticmethod
    def _key(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return mix(suffix ^ (prefix << U64(1)))

    def search(self, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of every place where all word hashes agree; texts are hashes[offsets[i]:offsets[i+1]]."""
        m, b = self.length, self.block
        size = np.diff(offsets)
        lanes = np.maximum(0, -(-(size - m + 1) // LANE))
        start = np.repeat(offsets[:-1], lanes) + LANE * ragged(np.zeros(len(lanes), np.int64), lanes)
        end = np.minimum(start + LANE + m - 1, np.repeat(offsets[1:], lanes))
        at, zero = start + m - 1, []
        while len(at):
            step = self.shift[self._slot(self._block(hashes[at - b + 1], hashes[at]))]
            hit = step == 0
            if hit.any():
                zero.append(at[hit])
            at = at + np.maximum(step, 1)
            go = at < end
            at, end = at[go], end[go]
        if not zero:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.concatenate(zero) - m + 1
        key = self._key(self._block(hashes[first + m - b], hashes[first + m - 1]), self._block(hashes[first], hashes[first + b - 1]))
        lo, hi = np.searchsorted(self.key, key), np.searchsorted(self.key, key, side="right")
        first, pattern = np.repeat(first, hi - lo), self.order[ragged(lo, hi - lo)]
        same = (hashes[first[:, None] + np.arange(m)] == self.hashes[pattern]).all(1)
        return first[same], pattern[same]


def build_patterns(items: list[tuple[str | None, str | None]], window: int) -> list[Patterns]:
    """Search tables of all windows of the items, one for each length (shorter items are one window of their own length).

    An item without a name owns no window, but its windows are searched too.
    """
    data, offsets = text_bytes(pa.array([t for _, t in items], pa.string()))
    hashes, start, end, word_at = words(data, offsets)
    low = data.tobytes().translate(_LOWER)
    by_length: dict[int, dict[bytes, tuple[int, list[str]]]] = {}
    for k, (item, _) in enumerate(items):
        a, b = int(word_at[k]), int(word_at[k + 1])
        m = min(window, b - a)
        for first in range(a, b - m + 1) if m else ():
            text = b" ".join(low[start[i] : end[i]] for i in range(first, first + m))
            owners = by_length.setdefault(m, {}).setdefault(text, (first, []))[1]
            if item is not None and item not in owners:
                owners.append(item)
    return [
        Patterns(np.stack([hashes[f : f + m] for f, _ in found.values()]), list(found), [o for _, o in found.values()])
        for m, found in by_length.items()
    ]


_BUILT: dict[str, list[Patterns]] = {}


def _patterns(name: str, block, window: int) -> list[Patterns]:
    """Tables of the block of a pass, built once in a worker; it keeps those of its last pass only."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = build_patterns(block.value, window)
    return _BUILT[name]


def scan_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (array<string>, sorted as strings), hit_spans and carried of every row of `docs`.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A pattern is `window` consecutive words of
    an item, or all its words where it has fewer; a document word inside any occurrence of a pattern is hit. item_ids are
    the items with an occurring pattern, hit_spans the byte ranges from the first to the last word of each run of hit
    words; carried is the struct of the columns `carry`, unchanged. A null text, and an item without words, has no words
    and no hits; an empty benchmark hits nothing; repeated rows are returned as they come, repeated items count once;
    items with a null id are searched like the others, so their words are hit, but item_ids does not name them; other
    columns are ignored.

    Documents are scanned whole where they are, without a shuffle. The benchmark is taken in blocks of about 16 MB, and the
    documents once for each: a pass broadcasts its block, adds to the hits of the passes before and, but for the last, writes
    them with the documents below `spark.checkpoint.dir`. So the driver and every worker hold one block at a time, however
    large the benchmark is.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // BLOCK_BYTES))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *carried_columns(carry, text_col),
        F.lit(None).cast("array<string>").alias("item_ids"), F.lit(None).cast(_SPANS).alias("hit_spans"),
    )
    tables = WorkTables(spark, "contamination")
    for k in range(passes):
        block = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k).collect() if total else []
        held = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in block])
        name = f"{spark.sparkContext.applicationId}/{held._jbroadcast.id()}"
        if k < passes - 1:
            rows = tables.store(_add_hits(rows, held, name, window), f"pass-{k}")
            held.destroy()
    found = _result(rows, held, name, window, carry, text_col, carried_field(docs, carry))
    tables.drop(rows)
    return found


_SPANS = "array<struct<start:long,end:long>>"


def _searched(batch: pa.RecordBatch, held, name: str, window: int) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Runs of rows [lo, hi) of a batch (id, text, ..., item_ids and hit_spans so far) and what is found in them."""
    data, offsets = text_bytes(batch.column(1))
    for lo, hi in slices(offsets, 1 << 22):
        part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        yield lo, hi, _scan(batch.slice(lo, hi - lo), part, at, _patterns(name, held, window))


def _add_hits(rows: DataFrame, held, name: str, window: int) -> DataFrame:
    """`rows` with the items and spans of one block added to theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, found in _searched(batch, held, name, window):
                same = [c.slice(lo, hi - lo) for c in batch.columns[:-2]]
                yield pa.RecordBatch.from_arrays([*same, found["item_ids"], found["hit_spans"]], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def _result(rows: DataFrame, held, name: str, window: int, carry: tuple[str, ...], text_col: str, field: StructField) -> DataFrame:
    """The result's columns, with the hits of the last block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, found in _searched(batch, held, name, window):
                yield found.append_column("carried", carried(batch, carry, text_col, lo, hi))

    found = StructType.fromDDL(f"n_words long, n_hit long, item_ids array<string>, hit_spans {_SPANS}")
    return rows.mapInArrow(run, StructType([rows.schema["doc_id"], *found.fields, field]))


def _scan(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, tables: list[Patterns]) -> pa.RecordBatch:
    ids, spans_before = batch.column(0), batch["hit_spans"]
    hashes, start, end, word_at = words(data, offsets)
    cover = np.zeros(len(hashes) + 1, np.int64)
    found: dict[int, set[str]] = {k: set(x) for k, x in enumerate(batch["item_ids"].to_pylist()) if x}
    if spans_before.null_count < len(ids):
        flat = spans_before.flatten()  # byte ranges of whole words that passes before hit
        base = offsets[:-1][np.repeat(np.arange(len(ids)), spans_before.value_lengths().fill_null(0).to_numpy())]
        np.add.at(cover, np.searchsorted(start, flat.field("start").to_numpy() + base), 1)
        np.add.at(cover, np.searchsorted(start, flat.field("end").to_numpy() + base), -1)
    for patterns in tables:
        first, pattern = patterns.search(hashes, word_at)
        if not len(first):
            continue
        m = patterns.length
        sure = np.zeros(len(first), bool)
        for k, (f, p) in enumerate(zip(first.tolist(), pattern.tolist(), strict=True)):
            text = data[start[f] : end[f + m - 1]].tobytes().translate(_LOWER)
            at = start[f]
            sure[k] = b" ".join(text[start[i] - at : end[i] - at] for i in range(f, f + m)) == patterns.texts[p]
        first, pattern = first[sure], pattern[sure]
        np.add.at(cover, first, 1)
        np.add.at(cover, first + m, -1)
        row = np.searchsorted(word_at, first, side="right") - 1
        for r, p in {*zip(row.tolist(), pattern.tolist(), strict=True)}:
            found.setdefault(r, set()).update(patterns.items[p])
    hit = np.cumsum(cover[:-1]) > 0
    hits = np.append(0, np.cumsum(hit))
    n = len(ids)
    # runs of hit words, cut at the ends of texts
    edge = hit & ~np.append(False, hit[:-1])
    heads = word_at[:-1][word_at[:-1] < len(hit)]
    edge[heads] |= hit[heads]
    stop = hit & ~np.append(hit[1:], False)
    tails = word_at[1:][word_at[1:] > 0] - 1
    stop[tails] |= hit[tails]
    row = np.searchsorted(word_at, np.flatnonzero(edge), side="right") - 1
    spans_at = np.append(0, np.cumsum(np.bincount(row, minlength=n)))
    base = offsets[row]
    spans = pa.StructArray.from_arrays(
        [pa.array(start[edge] - base, pa.int64()), pa.array(end[stop] - base, pa.int64())], names=["start", "end"]
    )
    return pa.RecordBatch.from_arrays(
        [
            ids, pa.array(np.diff(word_at)), pa.array(hits[word_at[1:]] - hits[word_at[:-1]]),
            pa.array([sorted(found.get(k, ())) for k in range(n)], pa.list_(pa.string())),
            pa.ListArray.from_arrays(pa.array(spans_at, pa.int32()), spans),
        ],
        names=["doc_id", "n_words", "n_hit", "item_ids", "hit_spans"],
    )
