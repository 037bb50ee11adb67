"""Cutting texts into units that a tokenizer treats independently, and a table of the units met so far."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import xxhash

from tickloom.llm.arrays import SLICE, U64, mix, prefix_hash, span_hash

#: Units kept by a worker before it starts anew, and slots they are hashed to.
MOST_UNITS, SLOTS = 1_500_000, 1 << 22
_NONE = U64(0)
LONG = 256
#: Punctuation that starts a pre-token of its own after a letter.
MARKS = b".,;:!?)]}\"*$%&#"
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: First bytes of the white space characters beyond ASCII.
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _outside(data: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Those of the places whose character is neither the first nor the last of its text nor next to what may be white space."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    at = at[~(edge[at] | edge[at + 1])] if len(at) else at
    before, after = data[at - 1], data[at + 1]
    wide = (before >= 0x80) & ((data[np.maximum(at - 2, 0)] == 0xC2) | _LEADS[data[np.maximum(at - 3, 0)]])
    return at[~(_WHITE[before] | _WHITE[after] | wide | _LEADS[after])]


def pretoken_cuts(data: np.ndarray, offsets: np.ndarray, marks: bytes) -> np.ndarray:
    """Places inside texts that no pre-token of the byte-level pattern runs over.

    They are: before a space, and before and after a line feed, between two characters that are certainly no white space
    (beyond ASCII a neighbour that might be white space by its first byte counts as such); and between an ASCII letter
    and one of `marks`, punctuation that no special token holds.
    """
    spaces = _outside(data, offsets, np.flatnonzero(data == 32))
    lines = _outside(data, offsets, np.flatnonzero(data == 10))
    is_mark = np.zeros(256, bool)
    is_mark[list(marks)] = True
    at = np.flatnonzero(is_mark[data])
    at = at[at > 0]
    at = at[_LETTER[data[at - 1]]]
    cut = np.zeros(len(data) + 2, bool)
    cut[at] = True
    cut[offsets] = False
    cut[spaces] = cut[lines] = cut[lines + 1] = True
    return np.flatnonzero(cut)


def pair_cuts(data: np.ndarray, offsets: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Places inside texts between two ASCII characters, or before a space, where joined[a, b] is false: nothing joins them."""
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = ~joined[data[:-1], data[1:]]
    cut[offsets] = False
    return np.flatnonzero(cut)


class UnitTable:
    """Numbers the distinct units of texts from 0; `learn(new units as bytes, which of them start a text)` is called for new ones.

    Units are told apart by 64-bit hashes in an open-addressing table of numpy arrays; those of LONG bytes and more by a
    hash that is no polynomial, as texts of that length with equal polynomials can be made on purpose. When MOST_UNITS are known, all are
    forgotten (`forget` is called) before the next slice.
    """

    def __init__(self, learn: Callable[[list[bytes], list[bool]], None], forget: Callable[[], None], firsts_differ: bool):
        self.learn, self.forget, self.firsts_differ = learn, forget, firsts_differ
        self._clear()

    def _clear(self) -> None:
        self.key, self.number, self.known, self.probes = np.zeros(SLOTS, U64), np.zeros(SLOTS, np.int32), 0, 1
        self.forget()

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> U64(40)).astype(np.int64) & (SLOTS - 1)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Number of every key, -1 where it is new."""
        out = np.full(len(keys), -1, np.int64)
        at, open_ = self._slots(keys), None
        for _ in range(self.probes):
            want = keys if open_ is None else keys[open_]
            held = self.key[at]
            hit = held == want
            if open_ is None:
                out[hit] = self.number[at[hit]]
                go = np.flatnonzero(~hit & (held != _NONE))
                open_ = go
            else:
                out[open_[hit]] = self.number[at[hit]]
                go = np.flatnonzero(~hit & (held != _NONE))
                open_ = open_[go]
            if not len(go):
                break
            at = (at[go] + 1) & (SLOTS - 1)
        return out

    def _insert(self, keys: np.ndarray) -> None:
        numbers = np.arange(self.known, self.known + len(keys))
        at, probes = self._slots(keys), 0
        left = np.arange(len(keys))
        while len(left):
            probes += 1
            free = self.key[at] == _NONE
            self.key[at[free]] = keys[left[free]]
            mine = self.key[at] == keys[left]
            self.number[at[mine]] = numbers[left[mine]]
            left, at = left[~mine], (at[~mine] + 1) & (SLOTS - 1)
        self.probes = max(self.probes, probes + 1)
        self.known += len(keys)

    def numbers(self, data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers, start bytes) of consecutive units, which start at the texts and at `cuts`, some megabyte at a time.

        What is known about the numbers holds until the next ones are asked for.
        """
        heads = offsets[:-1][np.diff(offsets) > 0]
        start = np.concatenate([heads, cuts])
        is_head = np.zeros(len(start), bool)
        is_head[: len(heads)] = True
        order = np.argsort(start, kind="stable")
        start, is_head = start[order], is_head[order]
        end = np.append(start[1:], len(data))
        lo = 0
        while lo < len(start):
            hi = max(lo + 1, int(np.searchsorted(end, start[lo] + SLICE, side="right")))
            if self.known > MOST_UNITS:
                self._clear()
            base = start[lo]
            keys = span_hash(prefix_hash(data[base : end[hi - 1]]), start[lo:hi] - base, end[lo:hi] - base)
            for k in np.flatnonzero(end[lo:hi] - start[lo:hi] >= LONG) + lo:
                keys[k - lo] = xxhash.xxh3_64_intdigest(data[start[k] : end[k]].tobytes())
            if self.firsts_differ:
                keys[is_head[lo:hi]] = mix(keys[is_head[lo:hi]] + U64(1))
            keys = np.maximum(keys, U64(1))
            out = self._find(keys)
            new = np.flatnonzero(out < 0)
            if len(new):
                _, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
                pick = new[first]
                texts = [data[a:b].tobytes() for a, b in zip(start[lo + pick].tolist(), end[lo + pick].tolist(), strict=True)]
                out[new] = self.known + back
                self.learn(texts, is_head[lo + pick].tolist())
                self._insert(keys[pick])
            yield out, start[lo:hi]
            lo = hi


class Sequences:
    """Growing ragged array of 32-bit ids, one sequence for each number."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.flat, self.start, self.known, self.used = np.zeros(1 << 20, np.int32), np.zeros(1 << 16, np.int64), 0, 0

    def extend(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(ids), len(self.flat)), np.int32)])
        if self.known + len(sizes) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros(max(len(sizes) + 1, len(self.start)), np.int64)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[self.known + 1 : self.known + 1 + len(sizes)] = self.used + np.cumsum(sizes)
        self.known, self.used = self.known + len(sizes), self.used + len(ids)
