"""Columns of whole numbers packed in one binary value, and numbers dealt to ranges: shuffles carry blocks instead of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def _planes(values: np.ndarray) -> bytes:
    """Bytes of whole numbers, all lowest ones first, so that equal high bytes stand together."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def squeeze(plain: bytes) -> bytes:
    """Compressed bytes that know their length."""
    return len(plain).to_bytes(8, "little") + pa.compress(plain, codec="zstd", asbytes=True)


def expand(packed: bytes) -> bytes:
    """What `squeeze` was given."""
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, compressed."""
    return squeeze(b"".join(map(_planes, columns)))


def unpack(packed: bytes, columns: int = 1) -> list[np.ndarray]:
    """The columns that `pack` was given."""
    planes = np.frombuffer(expand(packed), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).view("<i8").ravel() for p in planes]


def dealt(ranges: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Every range with the entries that belong to it, in their order."""
    order = np.argsort(ranges, kind="stable")
    cuts = np.flatnonzero(np.diff(ranges[order])) + 1
    for at in np.split(order, cuts) if len(order) else ():
        yield int(ranges[at[0]]), at
