"""Encoding into subword pieces and back, by Viterbi recursions shared along the common prefixes of sorted words."""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType

from tickloom.llm.arrays import ragged, slices, text_bytes
from tickloom.llm.units import Sequences, UnitTable, pair_cuts

MARK = "▁"
#: A word with the run of marks before it.
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PieceModel:
    """Pieces, scores and byte fall-back of a trained model; encodes many words in one trie walk.

    `merges=False` reads the scores as log probabilities of a unigram model: the segmentation of greatest total score
    is taken, the longest last piece among equals. `merges=True` reads them as merge priorities: a step of the recursion
    may extend the path of a prefix only by a piece that merging keeps apart from the path's last piece, which leaves one
    path for every prefix, the one that merging by priority gives. Characters without a piece become their UTF-8 bytes.
    """

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int], unknown: int, merges: bool, special: set[int] = frozenset()):
        self.pieces, self.scores, self.merges, self.unknown = list(pieces), scores, merges, unknown
        plain = [i for i in range(len(pieces)) if i not in special and i not in byte_ids.values()]
        self.id = {pieces[i]: i for i in plain}
        if any(re.search(f"[^{MARK}]{MARK}", pieces[i]) for i in plain):
            raise ValueError("a piece runs over the start of a word: words are not independent")
        self.real = len(pieces)  # numbers from here on stand for characters without a piece
        self.lone: dict[str, int] = {}
        self.heads = {pieces[i][:k] for i in plain for k in range(len(pieces[i]) + 1)}
        self.steps: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}
        self.byte_ids = byte_ids
        self.raw = [p.encode() for p in pieces]
        for byte, i in byte_ids.items():
            self.raw[i] = bytes([byte])
        for i in special:
            self.raw[i] = b""
        self.stable: dict[int, bool] = {}
        # bytes a, b that may stand side by side in a piece; all but ASCII are taken to, the mark is a space
        self.joined = np.ones((256, 256), bool)
        self.joined[:128, :128] = False
        self.joined[:, 32] = False
        self.joined[0x81, 32] = True  # the last byte of a mark written in the text
        for i in plain:
            for a, b in itertools.pairwise(self.pieces[i].replace(MARK, " ")):
                if ord(a) < 128 and ord(b) < 128:
                    self.joined[ord(a), ord(b)] = True
        self.unseen = min(scores, default=0.0) - 10.0  # of a character without a piece

    def merged(self, symbols: list[str]) -> list[str]:
        """Symbols after merging the adjacent pair of greatest score, the leftmost of equals, until none is a piece."""
        symbols = list(symbols)
        while True:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                i = self.id.get(symbols[k] + symbols[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def _apart(self, left: int, right: int) -> bool:
        """Whether merging the characters of both pieces (of the right one alone if left is -1) ends in just these."""
        if len(self.stable) > 400_000:
            self.stable.clear()
        a, b = "" if left < 0 else self.pieces[left], self.pieces[right]
        known = self.stable[left << 32 | right] = self.merged(list(a + b)) == ([a, b] if a else [b])
        return known

    def _step(self, seen: str) -> tuple[str, tuple[tuple[int, int], ...]]:
        """After the characters `seen`: the longest end of them that starts a piece, and the (piece, length) that end there, longest first."""
        if len(self.steps) > 400_000:
            self.steps.clear()
        state = seen
        while state not in self.heads:
            state = state[1:]
        ends = [(self.id[seen[k:]], len(seen) - k) for k in range(len(seen)) if seen[k:] in self.id]
        if not ends or ends[-1][1] > 1:  # the last character alone is no piece
            char = seen[-1]
            if char not in self.lone:
                self.lone[char] = len(self.pieces)
                self.pieces.append(char)
            ends.append((self.lone[char], 1))
        out = self.steps[seen] = (state, tuple(ends))
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of every word. Words are walked in sorted order; the states of a prefix shared with the word before stay."""
        order = sorted(range(len(words)), key=words.__getitem__)
        out: list[list[int]] = [[] for _ in words]
        steps, stable, merges = self.steps, self.stable, self.merges
        before, states, total = "", [""], [0.0]
        last, length = [-1], [0]  # last piece of the path over each prefix, and its length
        for number in order:
            word, shared = words[number], 0
            for a, b in zip(before, word):  # noqa: B905
                if a != b:
                    break
                shared += 1
            del states[shared + 1 :], last[shared + 1 :], length[shared + 1 :], total[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                seen = states[-1] + word[end - 1]
                state, ends = steps.get(seen) or self._step(seen)
                states.append(state)
                if merges:
                    for piece, size in ends:
                        left = last[end - size]
                        known = stable.get(left << 32 | piece)
                        if known is None:
                            known = self._apart(left, piece)
                        if known:
                            break
                    value = 0.0
                else:
                    value, _, piece, size = max((total[end - n] + (self.scores[i] if i < self.real else self.unseen), n, i, n) for i, n in ends)
                total.append(value)
                last.append(piece)
                length.append(size)
            path, end = out[number], len(word)
            while end:
                path.append(last[end])
                end -= length[end]
            path.reverse()
            if max(path, default=0) >= self.real:
                out[number] = [i for p in path for i in self._known(p)]
            before = word
        return out

    def _known(self, piece: int) -> list[int]:
        if piece < self.real:
            return [piece]
        return [self.byte_ids[b] for b in self.pieces[piece].encode()] if self.byte_ids else [self.unknown]

    def decode_bytes(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """UTF-8 texts of the sequences ids[ends[i]:ends[i + 1]]: pieces and bytes joined, marks as spaces, without the mark before the text."""
        if not hasattr(self, "plain"):
            plain = [r.replace(MARK.encode(), b" ") for r in self.raw]
            self.size = np.fromiter(map(len, plain), np.int64, len(plain))
            self.at = np.append(0, np.cumsum(self.size))[:-1]
            self.plain = np.frombuffer(b"".join(plain), np.uint8)
        size = self.size[ids]
        text = self.plain[ragged(self.at[ids], size)].tobytes()
        cut = np.append(0, np.cumsum(size))[ends].tolist()
        return [text[a + (text[a : a + 1] == b" ") : b] if a < b else b"" for a, b in itertools.pairwise(cut)]

    def decode(self, ids: list[int]) -> str:
        """Text of one sequence; bytes that are no UTF-8 become the replacement character."""
        return self.decode_bytes(np.array(ids, np.int64), np.array([0, len(ids)]))[0].decode(errors="replace").replace(MARK, " ")


@functools.cache
def piece_model(path: str, merges: bool = True) -> PieceModel:
    """The model file's pieces, read once per worker."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.vocab_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
    byte_ids = {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
    return PieceModel(pieces, [sp.get_score(i) for i in range(n)], byte_ids, sp.unk_id(), merges, special)


@functools.cache
def _worker(path: str, merges: bool) -> tuple[PieceModel, UnitTable, Sequences]:
    """The model, the units this worker met and their ids."""
    model, ids = piece_model(path, merges), Sequences()

    def learn(units: list[bytes], heads: list[bool]) -> None:
        words = [marked_words((" " if head else "") + u.decode()) for u, head in zip(units, heads, strict=True)]
        got = model.encode_words([w for some in words for w in some])
        at, sizes = 0, []
        for some in words:
            sizes.append(sum(map(len, got[at : at + len(some)])))
            at += len(some)
        ids.extend(np.fromiter(itertools.chain.from_iterable(got), np.int32, sum(sizes)), np.array(sizes, np.int64))

    return model, UnitTable(learn, ids.clear, firsts_differ=True), ids


def marked_words(text: str) -> list[str]:
    """Words of a text, each with the run of marks that stands for the spaces before it."""
    return _WORD.findall(text.replace(" ", MARK))


def encode_pieces(docs: DataFrame, model: str, merges: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, ids (array<int>), ids_crc32 (of little-endian 32-bit ids) and round_trip of every row.

    `model` is the path of a piece model on every executor. round_trip tells whether decoding the ids gives the text
    again; it is false only where the text itself holds the word mark, which reads as a space. A null text is empty and has no ids; repeated
    rows and null ids are returned as they come; other columns are ignored. Texts are encoded whole, in parts cut at
    inner spaces.
    """
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_pieces long, ids array<int>, ids_crc32 long, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spm, table, known = _worker(model, merges)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                flat, sizes = [np.zeros(0, np.int32)], np.zeros(hi - lo, np.int64)
                for numbers, start in table.numbers(part, at, pair_cuts(part, at, spm.joined)):
                    begin = known.start[numbers]
                    size = known.start[numbers + 1] - begin
                    flat.append(known.flat[ragged(begin, size)])
                    sizes += np.bincount(np.searchsorted(at, start, side="right") - 1, size, hi - lo).astype(np.int64)
                ids = np.concatenate(flat)
                ends = np.append(0, np.cumsum(sizes))
                same = spm.decode_bytes(ids, ends)
                crcs = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in itertools.pairwise(ends.tolist())]
                texts = [part[a:b].tobytes() for a, b in itertools.pairwise(at.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                        pa.array(crcs, pa.int64()), pa.array([a == b for a, b in zip(same, texts, strict=True)], pa.bool_()),
                    ],
                    names=["doc_id", "n_pieces", "ids", "ids_crc32", "round_trip"],
                )

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)


def decode_pieces(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """The rows with a column `text` decoded from their ids; null ids give the empty text."""
    columns = [c for c in encoded.columns if c != "text"]
    schema = encoded.select(*columns).schema.add("text", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spm = piece_model(model)
        for batch in batches:
            texts = [spm.decode(ids or []) for ids in batch.column(columns.index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*columns, "text"])

    return encoded.select(*columns).mapInArrow(run, schema)
