"""Exact removal of repeated byte strings with suffix arrays built by linear grouping.

A string of `length` bytes can repeat only where its least-hashed GRAM-byte gram (its anchor) repeats, and it stands at
the same place around that anchor. So the corpus falls apart by anchor: the strings of a text that share one anchor
occurrence form its context, some 580 bytes. Contexts that agree as a whole are decided by counting. The distinct
contexts of an anchor that differ are compared by a suffix array over their BLOCK-byte blocks, cut from the anchor on:
suffixes that share as many blocks as any string of `length` bytes holds stand together in it, and comparing the strings
in such a class finds the repeated ones exactly. The strings of anchors with very many different contexts are counted
in ranges of their hashes instead, so no anchor fills a task.

Steps are written to the shared work folder, and each step's files go when the next is done.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.arrays import U64, mix, prefix_hash, ragged, slices, span_hash, text_bytes
from tickloom.llm.packed import dealt, pack, unpack
from tickloom.session import remove_path, work_path

GRAM, BLOCK = 32, 16
#: Bytes of the strings that can be looked for.
SHORTEST, LONGEST = 2 * BLOCK + GRAM - 1, GRAM + 1022
#: Bytes of a text whose anchors are found at a time; positions inside fit the low bits of a key.
SEGMENT_BITS = 20
#: Different contexts of an anchor that one task compares by suffix array, and blocks in one array.
GROUP_CONTEXTS, ARRAY_BLOCKS = 96, 1 << 15
#: Strings of crowded anchors per range of hashes.
RANGE_STRINGS = 1 << 21


def suffix_array(text: list[int]) -> list[int]:
    """Positions of `text` in the order of the suffixes that start there, in linear time.

    First suffixes are grouped by their longest Lyndon prefix: groups are taken in descending order, each suffix finds
    the nearest position before it in a lower group (its previous smaller one), and the positions found move to a new
    group right above their own, the higher the more suffixes of the group point to them. Then groups are filled in
    ascending order: the suffix at each rank places those whose Lyndon prefix ends where it starts.
    """
    n = len(text)
    if not n:
        return []
    symbols = {c: g for g, c in enumerate(sorted(set(text)))}
    group = [symbols[c] for c in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    under, over = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
    smaller, done = [-1] * n, bytearray(n)
    g = len(symbols) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = own
        moving: dict[tuple[int, int], list[int]] = {}
        target, pointers = -1, 0
        for i in own:
            j = i - 1
            while j >= 0 and done[j]:
                j = smaller[j]
            smaller[i] = j
            done[i] = 1
            if j != target:
                if target >= 0:
                    moving.setdefault((-pointers, group[target]), []).append(target)
                target, pointers = j, 0
            pointers += 1
        if target >= 0:
            moving.setdefault((-pointers, group[target]), []).append(target)
        for key in sorted(moving) if len(moving) > 1 else moving:
            old, new, moved = key[1], len(members), moving[key]
            members.append(moved)
            for j in moved:
                group[j] = new
            above = over[old]
            over.append(above)
            under.append(old)
            over[old] = new
            if above >= 0:
                under[above] = new
        g = under[g]
    place, free, g = 0, [0] * len(members), 0
    while g >= 0:
        free[g] = place
        place += sum(group[i] == g for i in members[g])
        g = over[g]
    order = [-1] * n
    for rank in range(-1, n):
        j = (n if rank < 0 else order[rank]) - 1
        while j >= 0 and done[j]:
            done[j] = 0
            g = group[j]
            order[free[g]] = j
            free[g] += 1
            j = smaller[j]
    return order


def repeated_windows(anchor: np.ndarray, lead: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of every string of `length` bytes that stands at two places of the contexts.

    Context i is data[offsets[i]:offsets[i + 1]], its anchor's hash and the bytes before the anchor are anchor[i], lead[i].
    """
    rows = len(offsets) - 1
    size = np.diff(offsets)
    need = (length - BLOCK + 1) // BLOCK  # whole blocks in any string of `length` bytes
    skip = lead % BLOCK
    blocks = np.maximum(0, (size - skip) // BLOCK)
    prefix = prefix_hash(data)
    owner = np.repeat(np.arange(rows), blocks)
    number = ragged(np.zeros(rows, np.int64), blocks)
    begin = offsets[owner] + skip[owner] + BLOCK * number
    _, symbol = np.unique(mix(span_hash(prefix, begin, begin + BLOCK) ^ anchor[owner]), return_inverse=True)
    # one string of symbols; every context ends in a symbol of its own
    text = np.empty(len(owner) + rows, np.int64)
    ends = np.cumsum(blocks + 1) - 1
    text[ends] = np.arange(rows)
    inner = np.ones(len(text), bool)
    inner[ends] = False
    text[inner] = symbol + rows
    at = np.flatnonzero(inner)
    block_at = np.full(len(text), -1, np.int64)
    block_at[at] = np.arange(len(at))
    order = np.array(suffix_array(text.tolist()), np.int64)
    block = block_at[order]
    whole = block >= 0
    whole[whole] &= (number[block[whole]] + need) <= blocks[owner[block[whole]]]
    order, block = order[whole], block[whole]
    if len(order) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.ones(len(order) - 1, bool)
    for k in range(need):
        same &= text[order[:-1] + k] == text[order[1:] + k]
    class_ = np.append(0, np.cumsum(~same))
    shared = np.append(same, False) | np.append(False, same)
    block, class_ = block[shared], class_[shared]
    # strings whose first whole block this is
    row = owner[block]
    last = skip[row] + BLOCK * number[block]
    first = np.maximum(0, last - BLOCK + 1)
    last = np.minimum(last, size[row] - length)
    many = np.maximum(0, last - first + 1)
    start = ragged(first, many)
    row, class_ = np.repeat(row, many), np.repeat(class_, many)
    key = span_hash(prefix, offsets[row] + start, offsets[row] + start + length) ^ mix(class_.astype(U64))
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[back] > 1
    return row[twice], start[twice]


def anchors(data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchor occurrences of a text, a segment at a time: anchor hash, context hash, first string, strings, bytes before the anchor."""
    room = (1 << SEGMENT_BITS) - length
    low = U64((1 << SEGMENT_BITS) - 1)
    for begin in range(0, len(data) - length + 1, room):
        part = data[begin : begin + room + length - 1]
        prefix = prefix_hash(part)
        at = np.arange(len(part) - GRAM + 1)
        gram = span_hash(prefix, at, at + GRAM)
        least = (gram & ~low) | at.astype(U64)
        reach, wide = 1, length - GRAM + 1
        while 2 * reach <= wide:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if wide > reach:
            least = np.minimum(least[: len(least) - (wide - reach)], least[wide - reach :])
        where = (least & low).astype(np.int64)
        first = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        last = np.append(first[1:], len(where)) - 1
        yield gram[where[first]], span_hash(prefix, first, last + length), first + begin, last - first + 1, where[first] - first


def _write(df: DataFrame, name: str) -> str:
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return path


def _drop(spark: SparkSession, *paths: str) -> None:
    """Delete finished steps in the work folder and let Spark's cleaner take the shuffle files of finished jobs."""
    for path in paths:
        remove_path(spark, path)
    spark._jvm.System.gc()


def _occurrences(docs: DataFrame, length: int) -> DataFrame:
    """One row per anchor occurrence: anchor, context, doc_id, text_hash and place (first string, strings, lead packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "context", "doc_id", "text_hash", "place"]
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            got: list[tuple[np.ndarray, ...]] = []
            rows, held = [], 0
            for row in range(batch.num_rows):
                for a, c, first, many, lead in anchors(data[offsets[row] : offsets[row + 1]], length):
                    got.append((a.view(np.int64), c.view(np.int64), (first << 20) | (many << 10) | lead))
                    rows.append((row, len(a)))
                    held += len(a)
                if held and (held > 1 << 16 or row == batch.num_rows - 1):
                    take = pa.array(np.repeat([r for r, _ in rows], [n for _, n in rows]))
                    a, c, place = (pa.array(np.concatenate(x)) for x in zip(*got, strict=True))
                    yield pa.RecordBatch.from_arrays([a, c, batch.column(0).take(take), batch.column(1).take(take), place], names=names)
                    got, rows, held = [], [], 0

    return docs.filter(F.octet_length("text") >= length).mapInArrow(
        run, "anchor long, context long, doc_id long, text_hash struct<hash:long,bytes:int>, place long"
    )


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """Bytes of the wanted contexts; `texts` has text and wanted: array of (anchor, context, copies, hot, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "context", "copies", "hot", "doc_id", "text_hash", "place", "body"]
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            wanted = batch.column(3)
            owner = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(wanted).to_numpy(zero_copy_only=False))
            flat = wanted.flatten()
            place = flat.field("place").to_numpy()
            begin = offsets[owner] + (place >> 20)
            size = ((place >> 10) & 1023) + length - 1
            for lo in range(0, len(owner), 1 << 13):
                cut = slice(lo, lo + (1 << 13))
                ends = np.append(0, np.cumsum(size[cut])).astype(np.int32)
                body = pa.BinaryArray.from_buffers(
                    pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data[ragged(begin[cut], size[cut])])]
                )
                part, take = flat.slice(lo, 1 << 13), pa.array(owner[cut])
                yield pa.RecordBatch.from_arrays(
                    [*(part.field(c) for c in names[:4]), batch.column(0).take(take), batch.column(1).take(take), part.field("place"), body],
                    names=names,
                )

    return texts.select("doc_id", "text_hash", "text", "wanted").mapInArrow(
        run, "anchor long, context long, copies long, hot boolean, doc_id long, text_hash struct<hash:long,bytes:int>, place long, body binary"
    )


def _by_suffix_array(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of repeated strings of the contexts that occur once, anchor by anchor."""

    def solve(rows: pa.Table) -> pa.RecordBatch | None:
        data, offsets = text_bytes(rows["body"])
        place = rows["place"].to_numpy()
        anchor, context = rows["anchor"].to_numpy(), rows["context"].to_numpy()
        # a repeated row of the documents brings its contexts twice
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1]))
        keep = np.flatnonzero(new)
        size = np.diff(offsets)[keep]
        row, start = repeated_windows(
            anchor.view(U64)[keep], (place & 1023)[keep], data[ragged(offsets[keep], size)], np.append(0, np.cumsum(size)), length
        )
        row = keep[row]
        once = rows["copies"].to_numpy()[row] == 1
        row, start = row[once], start[once]
        if not len(row):
            return None
        order = np.lexsort((start, row))
        row, start = row[order], start[order]
        head = np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))
        tail = np.append(head[1:], True)
        take, base = pa.array(row[head]), (place >> 20)[row[head]]
        return pa.RecordBatch.from_arrays(
            [
                rows["doc_id"].combine_chunks().take(take), rows["text_hash"].combine_chunks().take(take),
                pa.array(base + start[head]), pa.array(base + start[tail] + length),
            ],
            names=["doc_id", "text_hash", "begin", "stop"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, blocks = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            blocks += len(batch.column(7).buffers()[2] or b"") // BLOCK
            if blocks >= ARRAY_BLOCKS:
                rows = pa.Table.from_batches(held).combine_chunks()
                anchor = rows["anchor"].to_numpy()
                cuts = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1  # an anchor's rows go together
                ends = np.cumsum(pa.compute.binary_length(rows["body"]).to_numpy()) // BLOCK
                lo = 0
                while len(cuts) and cuts[-1] > lo:
                    most = np.searchsorted(ends, (ends[lo - 1] if lo else 0) + ARRAY_BLOCKS)
                    fit = cuts[(cuts > lo) & (cuts <= max(most, cuts[cuts > lo][0]))]
                    out = solve(rows.slice(lo, fit[-1] - lo))
                    lo = int(fit[-1])
                    if out is not None:
                        yield out
                rest = rows.slice(lo)
                held, blocks = rest.to_batches(), int(ends[-1] - (ends[lo - 1] if lo else 0))
        if held and (out := solve(pa.Table.from_batches(held).combine_chunks())) is not None:
            yield out

    n = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        contexts.filter(~F.col("hot")).repartition(n, "anchor").sortWithinPartitions("anchor", "context")
        .mapInArrow(run, "doc_id long, text_hash struct<hash:long,bytes:int>, begin long, stop long")
    )


def _crowded_strings(rows: DataFrame, length: int, ranges: int) -> DataFrame:
    """The strings of every context of crowded anchors, packed by range of their hashes, and what the contexts are.

    Contexts are numbered inside a source, some thousand of them. Rows with a range hold (hash of anchor and string, context,
    place in the context, copies) of a source; the row without one holds the contexts themselves.
    """
    fields = pa.schema([
        ("range", pa.int64()), ("source", pa.int64()), ("numbers", pa.binary()), ("doc_id", pa.list_(pa.int64())),
        ("hash", pa.list_(pa.int64())), ("bytes", pa.list_(pa.int32())), ("begin", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        source = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = text_bytes(batch.column(5))
            anchor, copies, place = (batch.column(k).to_numpy() for k in (0, 1, 4))
            for lo, hi in slices(offsets):
                many = np.diff(offsets[lo : hi + 1]) - length + 1
                owner = np.repeat(np.arange(hi - lo), many)
                first = ragged(np.zeros(hi - lo, np.int64), many)
                start = offsets[lo + owner] - offsets[lo] + first
                hashes = span_hash(prefix_hash(data[offsets[lo] : offsets[hi]]), start, start + length) ^ mix(anchor[lo:hi].view(U64))[owner]
                source += 1
                columns = hashes.view(np.int64), owner, first, copies[lo:hi][owner]
                out = []
                for k, at in dealt((hashes % U64(ranges)).astype(np.int64)):
                    at = at[np.argsort(columns[0][at], kind="stable")]
                    out.append({"range": k, "source": source, "numbers": pack(*(c[at] for c in columns))})
                text = batch.column(3).slice(lo, hi - lo)
                out.append({
                    "source": source, "doc_id": batch.column(2).slice(lo, hi - lo).to_pylist(), "hash": text.field("hash").to_pylist(),
                    "bytes": text.field("bytes").to_pylist(), "begin": (place[lo:hi] >> 20).tolist(),
                })
                yield pa.RecordBatch.from_pylist(out, schema=fields)

    columns = rows.select("anchor", "copies", "doc_id", "text_hash", "place", "body")
    return columns.mapInArrow(run, "range long, source long, numbers binary, doc_id array<long>, hash array<long>, bytes array<int>, begin array<long>")


def _crowded_ends(strings: DataFrame) -> DataFrame:
    """For every source and range, packed: contexts with a repeated string that stands once among copies, their first and last such place."""
    schema = pa.schema([("source", pa.int64()), ("numbers", pa.binary())])

    def run(group: pa.Table) -> pa.Table:
        parts = [unpack(b, 4) for b in group["numbers"].to_pylist()]
        source = np.repeat(group["source"].to_numpy(), [len(p[0]) for p in parts])
        key, context, place, copies = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.argsort(key, kind="stable")
        new = np.append(True, np.diff(key[order]) != 0)
        which = np.cumsum(new) - 1
        places = np.add.reduceat(copies[order], np.flatnonzero(new))
        at = order[(places[which] > 1) & (copies[order] == 1)]
        if not len(at):
            return schema.empty_table()
        at = at[np.lexsort((place[at], context[at], source[at]))]
        head = np.append(True, (np.diff(context[at]) != 0) | (np.diff(source[at]) != 0))
        low, high = at[head], at[np.append(head[1:], True)]
        out = [(s, pack(context[low[k]], place[low[k]], place[high[k]])) for s, k in dealt(source[low])]
        return pa.Table.from_pylist([{"source": s, "numbers": b} for s, b in out], schema=schema)

    return strings.filter("range IS NOT NULL").select("range", "source", "numbers").groupBy("range").applyInArrow(run, "source long, numbers binary")


def _by_counting(contexts: DataFrame, length: int) -> tuple[DataFrame, str]:
    """Spans of repeated strings of the contexts of crowded anchors, and the work table they come from.

    A context has fewer strings than a string has bytes, so whatever lies between two repeated ones is covered by them: its first
    and last repeated string decide. Strings are counted by range of hashes, in blocks; a range is a bounded group, as
    ranges grow in number with the strings.
    """
    spark = contexts.sparkSession
    hot = contexts.filter("hot")
    total = hot.agg(F.sum(F.shiftright("place", 10).bitwiseAND(1023))).first()[0] or 0
    path = _write(_crowded_strings(hot.dropDuplicates(["anchor", "context"]), length, max(1, total // RANGE_STRINGS)), "crowded-strings")
    strings = spark.read.parquet(path)
    schema = "doc_id long, text_hash struct<hash:long,bytes:int>, begin long, stop long"

    def run(what: pa.Table, ends: pa.Table) -> pa.Table:
        parts = [unpack(b, 3) for b in ends["numbers"].to_pylist()]
        if parts:
            context, low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
        else:
            context, low, high = (np.zeros(0, np.int64) for _ in range(3))
        n = len(what["begin"][0]) if what.num_rows else 0
        first, last = np.full(n, 1 << 62), np.full(n, -1)
        np.minimum.at(first, context, low)
        np.maximum.at(last, context, high)
        take = np.flatnonzero(last >= 0)
        picked = {c: (what[c][0].values.to_numpy()[take] if n else np.zeros(0, np.int64)) for c in ("doc_id", "hash", "bytes", "begin")}
        text = pa.StructArray.from_arrays([pa.array(picked["hash"], pa.int64()), pa.array(picked["bytes"].astype(np.int32))], names=["hash", "bytes"])
        return pa.Table.from_arrays(
            [pa.array(picked["doc_id"], pa.int64()), text, pa.array(picked["begin"] + first[take]), pa.array(picked["begin"] + last[take] + length)],
            names=["doc_id", "text_hash", "begin", "stop"],
        )

    whats = strings.filter("range IS NULL").drop("range", "numbers").groupBy("source")
    return whats.cogroup(_crowded_ends(strings).groupBy("source")).applyInArrow(run, schema), path


def _keyed(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
        F.struct(F.xxhash64(text).alias("hash"), F.octet_length(text).alias("bytes")).alias("text_hash"), text.alias("text"),
        F.struct(F.lit(0).alias("none"), *(F.col(c) for c in carry)).alias("carried"),
    )


def repeated_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Path of a work table doc_id, text_hash, begin, stop: byte spans that cover every repeated string of `length` bytes.

    `length` is SHORTEST to LONGEST: a string holds some whole blocks, and its place fits a packed number.
    """
    if not SHORTEST <= length <= LONGEST:
        raise ValueError(f"length must be {SHORTEST} to {LONGEST} bytes")
    spark = docs.sparkSession
    texts = _keyed(docs, id_col, text_col)
    all_path = _write(_occurrences(texts.select("doc_id", "text_hash", "text"), length), "anchors")
    found = spark.read.parquet(all_path)
    kinds = (
        found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("context").alias("a"), F.max("context").alias("b"))
        .filter("n > 1").select("anchor", (F.col("a") != F.col("b")).alias("mixed"))
    )
    # sums are written before they are joined back, so that Spark may split the join where an anchor is hot
    kinds_path = _write(kinds, "anchor-kinds")
    again_path = _write(found.join(spark.read.parquet(kinds_path), "anchor"), "repeated-anchors")
    _drop(spark, all_path, kinds_path)

    again = spark.read.parquet(again_path)
    whole = (((F.shiftright("place", 20)) + F.shiftright("place", 10).bitwiseAND(1023)) + (length - 1)).alias("stop")
    spans = ["doc_id", "text_hash", F.shiftright("place", 20).alias("begin"), whole]
    mixed = again.filter("mixed").groupBy("anchor", "context").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_hash", "place")).alias("at")
    )
    mixed_path = _write(mixed, "contexts")
    mixed = spark.read.parquet(mixed_path)
    copied = again.filter("mixed").join(mixed.filter("copies > 1").select("anchor", "context"), ["anchor", "context"])
    counted_path = _write(again.filter("not mixed").select(*spans).unionByName(copied.select(*spans)), "copied-spans")
    _drop(spark, again_path)

    crowded_path = _write(mixed.groupBy("anchor").agg((F.count("*") > GROUP_CONTEXTS).alias("hot")), "crowded-anchors")
    wanted = (
        mixed.join(spark.read.parquet(crowded_path), "anchor").groupBy("at.doc_id", "at.text_hash")
        .agg(F.collect_list(F.struct("anchor", "context", "copies", "hot", F.col("at.place").alias("place"))).alias("wanted"))
    )
    body_path = _write(_contexts(texts.join(wanted, ["doc_id", "text_hash"]), length), "context-bodies")
    _drop(spark, mixed_path, crowded_path)

    bodies = spark.read.parquet(body_path)
    crowded, strings_path = _by_counting(bodies, length)
    path = _write(spark.read.parquet(counted_path).unionByName(_by_suffix_array(bodies, length)).unionByName(crowded), "repeated-spans")
    _drop(spark, body_path, counted_path, strings_path)
    return path


def remove_repeats(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256 and carried (struct of the columns `carry`) of every row of `docs`.

    Removed is each byte covered by a string of `length` bytes that also starts anywhere else in the table, in the same
    text included; strings overlap, never run over the end of a text, and are judged on the input. n_spans counts the
    maximal removed runs. A null text is empty; texts shorter than `length` stay; repeated rows are places of their own,
    so each loses all that is long enough; a null id counts as an id; an empty table gives no rows; other columns are
    ignored.
    """
    texts = _keyed(docs, id_col, text_col, carry)
    spans = docs.sparkSession.read.parquet(repeated_spans(docs, length, id_col, text_col))
    per_text = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("begin", "stop")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            size = pa.compute.fill_null(pa.compute.list_value_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
            at = np.append(0, np.cumsum(size))
            flat = batch.column(2).flatten()
            begin, stop = flat.field("begin").to_numpy(), flat.field("stop").to_numpy()
            for lo, hi in slices(offsets, 1 << 22):
                removed, runs, bodies, hashes = [], [], [], []
                for k in range(lo, hi):
                    text = data[offsets[k] : offsets[k + 1]]
                    if size[k]:
                        cover = np.zeros(len(text) + 1, np.int32)
                        np.add.at(cover, begin[at[k] : at[k + 1]], 1)
                        np.add.at(cover, stop[at[k] : at[k + 1]], -1)
                        gone = np.cumsum(cover[:-1]) > 0
                        removed.append(int(gone.sum()))
                        runs.append(int((gone & ~np.append(False, gone[:-1])).sum()))
                        text = text[~gone]
                    else:
                        removed.append(0)
                        runs.append(0)
                    bodies.append(text.tobytes())
                    hashes.append(hashlib.sha256(bodies[-1]).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets[lo : hi + 1])), pa.array(removed, pa.int64()),
                        pa.array(runs, pa.int64()), pa.array(bodies, pa.binary()), pa.array(hashes, pa.string()),
                        batch.column(3).slice(lo, hi - lo),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", "carried"],
                )

    rows = texts.join(per_text, ["doc_id", "text_hash"], "left").select(
        F.nullif("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "text", "spans", "carried"
    )
    found = StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return rows.mapInArrow(run, StructType([*found.fields, rows.schema["carried"]]))
