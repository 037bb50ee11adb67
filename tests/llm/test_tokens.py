"""Token counts, packed ids and pieces against the libraries, text by text."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tickloom.llm import pieces, token_counts, token_pack
from tickloom.llm import queries as Q

from . import cases

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "  x  y ", "\n\n a\n b  c\t\td  ", "don't 'll it's 's", "日本語テキスト 漢字" * 50, "a\xa0b 　c à la é à", "é" * 300, "a  b  c",
    " \n <|endoftext|>  <|endoftext|>", "x\x1c y \x1cz", "aaaa" * 40, "1234567 89 0", "<|endoftext|", "مرحبا بالعالم", "a <s> b</s>",
    " <unk>  <0x0A>", "ﬁ １ x　y", "🙂 smile 👩‍👩‍👧", "a\x00b", "a – b — “c” d", "e.g. it's <|endoftext|>.\nNew; x<|endoftext|>y, (a) a.b,c!!d..\n\nz",
    # two bytes in the order of bit parity, and exchanged: polynomials modulo 2**64 cannot tell such texts apart
    *("".join(pair[(k.bit_count() + turn) % 2] for k in range(n)) for n in (512, 1024, 2048) for pair in ("ac", "xy") for turn in (0, 1)),
]


def table(spark):
    rows = cases.edge_rows() + [(500 + k, t) for k, t in enumerate(ODD)]
    return rows, cases.documents(spark, rows)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def test_counts(spark, library):
    rows, docs = table(spark)
    want = [(i, len((t or "").encode()), len(library(t)), len(library(t)) > 100) for i, t in rows]
    got = token_counts.token_counts(docs, VOCABULARY, limit=100).collect()
    assert cases.counted(map(tuple, got)) == cases.counted(want)
    assert token_counts.token_counts(cases.empty(spark), VOCABULARY).count() == 0


def test_merge_table_on_single_tokens(library):
    merges = token_counts.MergeTable(VOCABULARY)
    words = ["aaa", " hello", "banana", "mississippi", "ababababab", "é", "x" * 500]
    assert merges.count([w.encode() for w in words]).tolist() == [len(library(w)) for w in words]


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 31, 32])
def test_packing(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 200_001)
    payload = token_pack.pack(ids, width)
    assert len(payload) == (len(ids) * width + 7) // 8
    assert (token_pack.unpack(payload, width, 0, len(ids)) == ids).all()
    assert (token_pack.unpack(payload, width, 70_001, 190_003) == ids[70_001:190_003]).all()
    assert len(token_pack.unpack(payload, width, 9, 9)) == 0


def test_sixteen_bits_are_packed_like_any_width():
    ids = np.random.default_rng(0).integers(0, 1 << 16, 1000)
    bits = (ids[:, None] >> np.arange(16)) & 1
    assert np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes() == token_pack.pack(ids, 16)


def test_blocks(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_pack, "BLOCK_IDS", 500)
    rows, docs = table(spark)
    path = str(tmp_path / "blocks")
    token_pack.write_blocks(docs, VOCABULARY, path)
    rank = lambda r: (r[0] is not None, r[0] or 0)
    got = sorted(token_pack.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r[0] for r in sorted(rows, key=rank)]
    start, texts = 0, {}
    for i, t in rows:
        texts.setdefault(i, []).append(library(t) + [0])
    for r in got:
        fit = [x for x in texts[r.doc_id] if (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) == (r.n_tokens, r.ids_crc32)]
        assert r.start == start and fit
        texts[r.doc_id].remove(fit[0])
        start += r.n_tokens
    whole = token_pack.read_span(spark, path, 0, start)
    assert len(whole) == start
    assert (token_pack.read_span(spark, path, 700, 900) == whole[700:1600]).all()
    assert token_pack.id_width(50257) == 16 and token_pack.id_width(2) == 1
    none = str(tmp_path / "none")
    token_pack.write_blocks(cases.empty(spark), VOCABULARY, none)
    assert token_pack.read_documents(spark, none).count() == 0


def test_pieces(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows, docs = table(spark)
    encoded = pieces.encode_pieces(docs, MODEL)
    got = encoded.collect()
    assert cases.counted((r.doc_id, r.ids, r.n_pieces) for r in got) == cases.counted(
        (i, library.encode(t or ""), len(library.encode(t or ""))) for i, t in rows
    )
    assert all(r.round_trip for r in got if not any("▁" in (t or "") for i, t in rows if i == r.doc_id))
    decoded = pieces.decode_pieces(encoded, MODEL)
    assert cases.counted((r.doc_id, r.text) for r in decoded.collect()) == cases.counted((i, (t or "").replace("▁", " ")) for i, t in rows)
    assert pieces.encode_pieces(cases.empty(spark), MODEL).count() == 0


def test_unigram_viterbi_against_all_segmentations():
    vocab = {"▁": -2.0, "a": -1.5, "b": -1.7, "ab": -2.0, "▁a": -2.2, "bab": -3.9, "▁ab": -4.5, "ba": -2.9}
    model = pieces.PieceModel(["<unk>", *vocab], [0.0, *vocab.values()], {}, 0, merges=False, special={0})

    def best(word):
        if not word:
            return 0.0
        return max((vocab[word[:k]] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in vocab), default=-1e9)

    words = ["▁" + "".join(w) for n in range(7) for w in __import__("itertools").product("ab", repeat=n)]
    for word, ids in zip(words, model.encode_words(words), strict=True):
        assert "".join(model.pieces[i] for i in ids) == word
        assert abs(sum(vocab[model.pieces[i]] for i in ids) - best(word)) < 1e-9
    assert model.encode_words(["▁axb"])[0].count(0) == 1


def test_queries(spark, library):
    texts = {r.doc_id: r.text for r in Q.table(spark, SF, "documents").collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counts = {r.doc_id: r.n_tokens for r in Q.op7_token_counts(spark, SF).collect()}
    packed = {r.doc_id: r for r in Q.op8_bit_pack(spark, SF).collect()}
    encoded = {r.doc_id: r for r in Q.op9_sentence_pieces(spark, SF).collect()}
    start = 0
    for i in sorted(texts):
        ids = library(texts[i])
        assert counts[i] == len(ids)
        crc = zlib.crc32(np.array([*ids, 0], "<u4").tobytes())
        assert (packed[i].start, packed[i].n_tokens, packed[i].ids_crc32) == (start, len(ids) + 1, crc)
        start += len(ids) + 1
        assert encoded[i].ids == sp.encode(texts[i]) and encoded[i].round_trip
    assert len(texts) == len(counts) == len(packed) == len(encoded)
