"""Numpy helpers over whole Arrow columns of texts: bytes, words, rolling hashes, ragged gathers.

Texts are handled in slices of a few megabytes, so that the memory of a task does not depend on its partition.
A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

U64 = np.uint64
#: Bytes worked on at a time.
SLICE = 1 << 20
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**n modulo 2**64, kept for the worker's life up to one slice's length."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(n, 4096) + 1, base, dtype=U64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=U64)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit value."""
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column and the n + 1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def carried_columns(names: tuple[str, ...], text: str) -> list[Column]:
    """Columns to hand to a task besides the id and the text, under names that clash with nothing."""
    return [F.col(n).alias(f"__carried_{k}") for k, n in enumerate(names) if n != text]


def carried_field(docs: DataFrame, names: tuple[str, ...]) -> StructField:
    """Schema field of what `carried` builds."""
    return StructField("carried", StructType([docs.schema[n] for n in names] or [StructField("none", IntegerType())]))


def carried(batch: pa.RecordBatch, names: tuple[str, ...], text: str, lo: int, hi: int) -> pa.StructArray:
    """Struct of the columns `names` of rows lo .. hi - 1; column 1 is the text, the others follow it in the order of the names."""
    others = iter(range(2, batch.num_columns))
    columns = [batch.column(1 if n == text else next(others)).slice(lo, hi - lo) for n in names]
    return pa.StructArray.from_arrays(columns, names=list(names)) if names else pa.nulls(hi - lo, pa.struct([("none", pa.int32())]))


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of rows [lo, hi) of at most `most` bytes together, or one longer row."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which `span_hash` takes the hash of any span."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data))[: len(data)], dtype=U64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every span; equal bytes and lengths give equal hashes wherever they stand."""
    back = _powers(_BACK, len(prefix))
    return mix((prefix[end] - prefix[start]) * back[start] + (end - start).astype(U64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every span, one after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    full = np.flatnonzero(lengths)
    begins = np.zeros(len(full), np.int64)
    np.cumsum(lengths[full][:-1], out=begins[1:])
    first = starts[full].astype(np.int64)
    out[begins] = first
    out[begins[1:]] -= first[:-1] + lengths[full][:-1] - 1
    return np.cumsum(out, out=out)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z, of texts laid end to end.

    Returns the hash, start and end byte of every word and the n + 1 word offsets of the texts.
    """
    hashes, firsts, lasts = [], [], []
    counts = np.zeros(len(offsets) - 1, np.int64)
    for lo, hi in slices(offsets):
        begin, stop = int(offsets[lo]), int(offsets[hi])
        while begin < stop:
            end = stop
            if stop - begin > 2 * SLICE:  # one long text: cut it where no word runs on
                end = begin + SLICE
                while end < stop and _IS_WORD[_LOWER[data[end - 1]]] and _IS_WORD[_LOWER[data[end]]]:
                    end += 1
            low = _LOWER[data[begin:end]]
            inside = _IS_WORD[low]
            edge = np.zeros(len(low) + 1, bool)
            edge[:-1] |= inside
            edge[1:] ^= inside
            cuts = offsets[lo + 1 : hi] - begin  # a word never runs over the end of its text
            cuts = cuts[(cuts > 0) & (cuts < len(low))]
            both = np.unique(cuts[inside[cuts - 1] & inside[cuts]])
            at = np.flatnonzero(edge)
            if len(both):
                at = np.sort(np.concatenate([at, both, both]))
            start, stop_at = at[0::2], at[1::2]
            hashes.append(span_hash(prefix_hash(low), start, stop_at))
            firsts.append(start + begin)
            lasts.append(stop_at + begin)
            if hi - lo == 1:
                counts[lo] += len(start)
            else:
                counts[lo:hi] += np.diff(np.searchsorted(start + begin, offsets[lo : hi + 1]))
            begin = end
    total = np.zeros(len(offsets), np.int64)
    np.cumsum(counts, out=total[1:])
    if not hashes:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), total
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(lasts), total


def shingles(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every n consecutive words of a text (of all its words where it has fewer), and text offsets."""
    count = np.diff(offsets)
    per = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    out = np.zeros(len(offsets), np.int64)
    np.cumsum(per, out=out[1:])
    at = ragged(offsets[:-1], per)
    step = _powers(0xD6E8FEB86659FD93, n)
    acc = np.zeros(len(at), U64)
    short = np.repeat(np.minimum(count, n), per)
    for k in range(n):
        take = k < short
        acc[take] += mix(hashes[at[take] + k]) * step[k + 1]
    return mix(acc + short.astype(U64)), out
