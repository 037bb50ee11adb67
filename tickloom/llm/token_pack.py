"""Token ids in a fixed-width bit-packed block format with block offsets.

A dataset is a Parquet folder of blocks. A block holds whole documents: `part` and `block` give its place, `first` the
ids of the part before it, `width` the bits of an id, `payload` the ids packed least significant bit first, `ids` their
number, and `doc_id` / `n_tokens` the documents in it. Parts ascend by doc_id. Since every id has the same width, any
span of ids is found by arithmetic; a reader fetches only the blocks that overlap it.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.arrays import ragged, slices, text_bytes
from tickloom.llm.units import MARKS, Sequences, UnitTable, pretoken_cuts

#: Ids after which a block is closed at the next document's end.
BLOCK_IDS = 1 << 17

BLOCKS = (
    "part int, block int, first long, width int, ids long, payload binary, doc_id array<long>, n_tokens array<long>"
)


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as consecutive `width`-bit numbers, least significant bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    out = []
    for lo in range(0, len(ids), 1 << 16):  # a multiple of 8 ids fills whole bytes
        bits = (ids[lo : lo + (1 << 16), None].astype(np.uint32) >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(payload: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids start .. stop - 1 of a block, as unsigned 32-bit numbers; reads only their bytes."""
    if stop <= start:
        return np.zeros(0, np.uint32)
    lo, hi = start * width // 8, (stop * width + 7) // 8
    if width in (8, 16, 32):
        return np.frombuffer(payload, f"<u{width // 8}", stop - start, lo).astype(np.uint32)
    out = []
    for a in range(start, stop, 1 << 16):
        b = min(stop, a + (1 << 16))
        lo, hi = a * width // 8, (b * width + 7) // 8
        bits = np.unpackbits(np.frombuffer(payload, np.uint8, hi - lo, lo), bitorder="little")
        skip = a * width - lo * 8
        bits = bits[skip : skip + (b - a) * width].reshape(-1, width)
        out.append(bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32)))
    return np.concatenate(out)


@functools.cache
def library_tokenizer(path: str):
    """The library's tokenizer, one per worker and path; Spark gives the cores, so it runs in one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class DocumentEncoder:
    """Ids of whole texts, from the library's ids of their distinct units."""

    def __init__(self, path: str, end_id: int):
        self.tokenizer, self.end_id, self.ids = library_tokenizer(path), end_id, Sequences()
        special = self.tokenizer.get_added_tokens_decoder()
        self.between = min(special) if special else None
        self.mark = special[self.between].content.encode() if special else b""
        self.marks = bytes(c for c in MARKS if not any(chr(c) in t.content for t in special.values()))
        self.table = UnitTable(self._learn, self.ids.clear, firsts_differ=False)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: list[bytes], _: list[bool]) -> None:
        """Many units go to the library as one text, with a special token between them that none of them holds."""
        for lo in range(0, len(units), 512):
            some = units[lo : lo + 512]
            if self.between is not None and not any(self.mark in u for u in some):
                ids = np.array(self._encode([(self.mark.join(some) + self.mark).decode()])[0], np.int32)
                cut = ids == self.between
                ends = np.flatnonzero(cut)
                self.ids.extend(ids[~cut], np.diff(ends, prepend=-1) - 1)
            else:
                got = self._encode([u.decode() for u in some])
                sizes = np.fromiter(map(len, got), np.int64, len(got))
                self.ids.extend(np.fromiter(itertools.chain.from_iterable(got), np.int32, int(sizes.sum())), sizes)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, the end id after every text, and the number of ids of each text."""
        out, sizes = [], np.zeros(len(offsets) - 1, np.int64)
        for numbers, start in self.table.numbers(data, offsets, pretoken_cuts(data, offsets, self.marks)):
            begin = self.ids.start[numbers]
            size = self.ids.start[numbers + 1] - begin
            out.append(self.ids.flat[ragged(begin, size)])
            sizes += np.bincount(np.searchsorted(offsets, start, side="right") - 1, size, len(sizes)).astype(np.int64)
        ids = np.full(int(sizes.sum()) + len(sizes), self.end_id, np.int32)
        room = np.ones(len(ids), bool)
        room[np.cumsum(sizes + 1) - 1] = False
        ids[room] = np.concatenate(out) if out else 0
        return ids, sizes + 1


@functools.cache
def document_encoder(path: str, end_id: int) -> DocumentEncoder:
    """One encoder with its cache per worker."""
    return DocumentEncoder(path, end_id)


def id_width(vocabulary_size: int) -> int:
    """Fewest bits that hold every id."""
    return max(1, (vocabulary_size - 1).bit_length())


def write_blocks(docs: DataFrame, vocabulary: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text with the library's tokenizer and write the packed dataset at `path`.

    A null text is empty and holds the end id alone. Documents stand in ascending order of their id, null ids first,
    repeated ids by their text; an empty table gives an empty dataset. Other columns are ignored. Range partitioning is
    by id and text hash, so a repeated id does not land in one task. Spark's writer commits whole tasks, so lost
    executors leave no partial block.
    """
    width = id_width(library_tokenizer(vocabulary).get_vocab_size())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first = TaskContext.get().partitionId(), 0, 0
        encoder = document_encoder(vocabulary, end_id)
        held, held_ids, held_sizes, count = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal block, first, held, held_ids, held_sizes, count
            out = pa.RecordBatch.from_pylist(
                [{"part": part, "block": block, "first": first, "width": width, "ids": count, "payload": pack(np.concatenate(held), width), "doc_id": held_ids, "n_tokens": held_sizes}],
                schema=pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("width", pa.int32()), ("ids", pa.int64()), ("payload", pa.binary()), ("doc_id", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64()))]),
            )
            block, first = block + 1, first + count
            held, held_ids, held_sizes, count = [], [], [], 0
            return out

        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                ids, sizes = encoder.encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                held.append(ids)
                held_ids.extend(batch.column(0).slice(lo, hi - lo).to_pylist())
                held_sizes.extend(sizes.tolist())
                count += len(ids)
                if count >= BLOCK_IDS:
                    yield close()
        if held:
            yield close()

    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text").asc_nulls_first()]
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.repartitionByRange(n, *key[:2]).sortWithinPartitions(*key).mapInArrow(run, BLOCKS)
        .write.option("compression", "zstd").parquet(path)
    )


def part_starts(blocks: DataFrame) -> DataFrame:
    """part and the number of ids in all parts before it; one row per part, so one task orders them."""
    sums = blocks.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and the unsigned CRC-32 of its little-endian ids."""
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                ends = np.cumsum(b["n_tokens"])
                ids = unpack(b["payload"], b["width"], 0, b["ids"]).astype("<u4")
                crc = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends.tolist(), b["n_tokens"], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(b["doc_id"], pa.int64()), pa.array(b["part_start"] + b["first"] + ends - b["n_tokens"], pa.int64()),
                        pa.array(b["n_tokens"], pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return blocks.join(part_starts(blocks.select("part", "ids")), "part").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def read_span(spark: SparkSession, path: str, start: int, count: int) -> np.ndarray:
    """Ids start .. start + count - 1 of the dataset; fetches only the blocks that hold them."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    at = F.col("part_start") + F.col("first")
    rows = (
        blocks.join(part_starts(blocks.select("part", "ids")), "part")
        .filter((at < start + count) & (at + F.col("ids") > start))
        .select(at.alias("at"), "ids", "width", "payload").orderBy("at").toLocalIterator()
    )
    got = [unpack(r["payload"], r["width"], max(0, start - r["at"]), min(r["ids"], start + count - r["at"])) for r in rows]
    return np.concatenate(got) if got else np.zeros(0, np.uint32)
