"""Token counts by rank-synchronous merging of ragged numpy arrays."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tickloom.llm.arrays import slices, text_bytes
from tickloom.llm.units import MARKS, UnitTable, pretoken_cuts

#: Fixed value: the published pre-token pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> list[str]:
    """Letter that stands for each byte in the vocabulary: itself where printable, else the next code point from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class MergeTable:
    """Ranks of a byte-level merge vocabulary as arrays; counts tokens of many pre-tokens together."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.size = max(vocab.values()) + 1
        self.byte_id = np.array([vocab[c] for c in _byte_letters()], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        self.slots = 1 << (4 * len(keys)).bit_length()
        self._index(keys, np.array([vocab[a + b] for a, b in merges], np.int64))
        self.split = regex.compile(PATTERN)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.on_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) & (self.slots - 1)

    def _index(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """Open addressing: each round places the pairs whose slot is free, the others try the next slot."""
        self.none = len(keys)
        self.key_at = np.full(self.slots, -1, np.int64)
        self.rank_at = np.full(self.slots, self.none, np.int64)
        left, at, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(left):
            self.probes += 1
            free = self.key_at[at] < 0
            self.key_at[at[free]] = keys[left[free]]
            placed = self.key_at[at] == keys[left]
            self.rank_at[at[placed]] = left[placed]
            left, at = left[~placed], (at[~placed] + 1) & (self.slots - 1)
        self.merged = np.append(merged, -1)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = self._slot(keys)
        out = np.full(len(keys), self.none, np.int64)
        open_ = np.arange(len(keys))
        for _ in range(self.probes):
            held = self.key_at[at]
            hit = held == keys[open_]
            out[open_[hit]] = self.rank_at[at[hit]]
            go = ~hit & (held >= 0)
            if not go.any():
                break
            open_, at = open_[go], (at[go] + 1) & (self.slots - 1)
        return out

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols left of every pre-token after all merges."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        out = lengths.copy()
        sym = self.byte_id[np.frombuffer(b"".join(tokens), np.uint8)]
        seq = np.repeat(np.arange(len(tokens)), lengths)
        while len(sym) > 1:
            same = seq[1:] == seq[:-1]
            rank = np.where(same, self.ranks(sym[:-1], sym[1:]), self.none)
            starts = np.flatnonzero(np.append(True, ~same))
            least = np.minimum.reduceat(np.append(rank, self.none), starts)
            alive = least < self.none
            if not alive.any():
                break
            size = np.diff(np.append(starts, len(sym)))
            lowest = np.repeat(least, size)
            hit = np.append(rank == lowest[:-1], False) & (lowest < self.none)
            # of pairs that overlap (one symbol repeated), every second is merged, from the left
            begin = hit & ~np.append(False, hit[:-1])
            run = np.arange(len(sym)) - np.maximum.accumulate(np.where(begin, np.arange(len(sym)), 0))
            hit &= run % 2 == 0
            at = np.flatnonzero(hit)
            np.subtract.at(out, seq[at], 1)
            sym[at] = self.merged[lowest[at]]
            keep = np.repeat(alive, size)
            keep[at + 1] = False
            sym, seq = sym[keep], seq[keep]
        return out

    def count_units(self, units: list[str]) -> np.ndarray:
        """Tokens of each unit; a special token's string counts as one token, as in the library."""
        tokens, owner, extra = [], [], np.zeros(len(units), np.int64)
        for i, unit in enumerate(units):
            texts = [unit]
            if self.on_special is not None and any(s in unit for s in self.special):
                texts = self.on_special.split(unit)
                extra[i] = len(texts) - 1
            for text in texts:
                found = self.split.findall(text)
                tokens.extend(found)
                owner.extend([i] * len(found))
        if not tokens:
            return extra
        distinct = dict.fromkeys(tokens)
        counts = dict(zip(distinct, self.count([t.encode() for t in distinct]).tolist(), strict=True))
        got = np.fromiter(map(counts.__getitem__, tokens), np.int64, len(tokens))
        return extra + np.bincount(np.array(owner), got, len(units)).astype(np.int64)


@functools.cache
def _worker(path: str) -> tuple[UnitTable, list[np.ndarray], bytes]:
    """Units met by this worker and arrays of their token counts, one set per vocabulary."""
    merges, counts = MergeTable(path), []
    marks = bytes(c for c in MARKS if not any(chr(c) in s for s in merges.special))
    return UnitTable(lambda new, _: counts.append(merges.count_units([u.decode() for u in new])), counts.clear, firsts_differ=False), counts, marks


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row.

    `vocabulary` is the path of a byte-level merge vocabulary (tokenizer JSON) on every executor. Counts equal those of
    that library without added tokens; strings of special tokens inside a text count as one token. A null text is
    empty and has no tokens; repeated rows and null ids are returned as they come; other columns are ignored. Every
    text is counted whole, in parts cut at inner spaces, so memory does not depend on its length.
    """
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts, marks = _worker(vocabulary)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            n_tokens = np.zeros(batch.num_rows, np.int64)
            for lo, hi in slices(offsets, 1 << 22):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                for numbers, start in table.numbers(part, at, pretoken_cuts(part, at, marks)):
                    if len(counts) > 1:
                        counts[:] = [np.concatenate(counts)]
                    row = np.searchsorted(at, start, side="right") - 1
                    n_tokens[lo:hi] += np.bincount(row, counts[0][numbers], hi - lo).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(n_tokens), pa.array(n_tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)
