import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.cases import counted, documents, edge_rows, empty, prose
from tickloom.llm import queries, simhash
from tickloom.llm.arrays import text_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[k : k + 4]) for k in range(max(len(words) - 3, min(len(words), 1)))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_rows(rows, fingerprint=plain_fingerprint):
    """(doc_id, hex fingerprint, component_id, copies) by comparing every two rows."""
    fp = np.array([fingerprint(t) for _, t in rows], np.uint64)
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in zip(*np.nonzero(np.bitwise_count(fp[:, None] ^ fp) <= 4), strict=True):
        root[find(int(a))] = find(int(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return counted((i, f"{int(fp[k]):016x}", least.get(find(k)), int((fp == fp[k]).sum())) for k, (i, _) in enumerate(rows))


def test_fingerprints_of_odd_texts():
    import pyarrow as pa

    texts = [t for _, t in edge_rows()] + ["A b\x0bC\x0cd\x1ce\x85f", "\t x \n", " ".join("abcd"), "über Ümlaut ß one two"]
    assert [int(x) for x in simhash.fingerprints(*text_bytes(pa.array(texts)))] == [plain_fingerprint(t) for t in texts]


def test_long_text_in_blocks(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simhash, "BLOCK", 50)
    texts = [prose(1, 400), "a b", prose(2, 130), None, prose(3, 60)]
    assert [int(x) for x in simhash.fingerprints(*text_bytes(pa.array(texts)))] == [plain_fingerprint(t) for t in texts]


def test_every_link_meets_in_a_bucket():
    """Pairs of one to four differing bits, anywhere: each is found in a bucket and survives its budgets."""
    rng = random.Random(5)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << bit
        fp = np.array([a, b], np.uint64)
        row, key, home = simhash.chain_keys(fp)
        found = False
        for k in np.intersect1d(key[row == 0], key[row == 1]):
            at = [np.flatnonzero((row == r) & (key == k))[0] for r in (0, 1)]
            found |= bool(simhash.near_pairs(fp, home[at], np.zeros(2, int), int(k) >> 26, False).any())
        assert found


@pytest.mark.parametrize("chunk", [1024, 8])
def test_edges_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    base = prose(9, 60).split(" ")
    rng = random.Random(3)
    rows = edge_rows()
    for k in range(60):  # a hot group of near copies
        words = list(base)
        words[rng.randrange(60)] = f"w{k % 20}"
        rows.append((100 + k, " ".join(words)))
    rows += [(300 + k, "the same line") for k in range(40)]
    got = simhash.simhash_components(documents(spark, rows)).select("doc_id", "fingerprint", "component_id", "copies").collect()
    assert counted(map(tuple, got)) == plain_rows(rows)


def test_crowded_buckets_and_chains(spark, monkeypatch):
    """Fingerprints a few bits apart: long chains of links through one crowded bucket."""
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rng = random.Random(8)
    values = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(300):
        value = rng.choice(values[-40:])
        for bit in rng.sample(range(64), rng.randint(2, 5)):
            value ^= 1 << bit
        values.append(value)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    work = simhash.WorkTables(spark, "test")
    got = simhash.linked_fingerprints(spark.createDataFrame(sorted(set(signed)), "fp long"), work).collect()
    root = {r["node"]: r["root"] for r in got}
    rows = [(k, v) for k, (v,) in enumerate(signed)]
    want = plain_rows(rows, lambda v: v % (1 << 64))
    first = {}
    for k, v in rows:
        first.setdefault(root.get(v, v), k)
    assert counted((k, f"{v % (1 << 64):016x}", first[root.get(v, v)], sum(v == w for _, w in rows)) for k, v in rows) == want


def test_empty(spark):
    assert simhash.simhash_components(empty(spark)).collect() == []


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_simhash"](spark, "/root/testdata/sf0.001").select("doc_id", "fingerprint", "component_id", "copies").collect()
    assert counted(map(tuple, got)) == plain_rows(rows)
