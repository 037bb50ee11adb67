"""SimHash near copies, found by pigeonring filtering.

A fingerprint of 64 bits stands on a ring of SEGMENTS segments. If two fingerprints differ in at most NEAR bits, the ring
has a segment from which every chain of n consecutive segments holds at most n * NEAR / SEGMENTS differences. With five
segments and four differences the budgets are 0, 1, 2, 3 and 4: the first segment agrees and the second differs in one
bit at most. Both make the key of a bucket; longer chains prune pairs inside it, before the whole fingerprints are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrays import U64, ragged, slices, text_bytes
from tickloom.llm.components import components
from tickloom.llm.work import WorkTables

SHINGLE, SEED = 4, 42
#: Differing bits of linked fingerprints at most.
NEAR = 4
SEGMENTS = 5
#: First bit and width of every segment.
_AT = [0, 13, 26, 39, 52]
_WIDTH = [13, 13, 13, 13, 12]
#: Members of a bucket that are compared with each other at once; larger buckets are compared chunk by chunk.
CHUNK = 1024
#: Shingles hashed at a time.
BLOCK = 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words of all texts, each followed by a space, and the start, end and text number of every shingle in them."""
    low = _LOWER[data]
    inside = ~_IS_SPACE[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]  # a text starts a word even if the one before ends in one
    begins[first] = inside[first]
    start = np.flatnonzero(begins)
    run = np.cumsum(inside)
    length = np.diff(np.append(run[start] - 1, run[-1] if len(run) else 0))
    out = np.append(0, np.cumsum(length + 1))
    joined = np.full(out[-1], 0x20, np.uint8)
    joined[ragged(out[:-1], length)] = low[inside]
    per_text = np.diff(np.searchsorted(start, offsets))
    word = np.append(0, np.cumsum(per_text))
    shingles = np.where(per_text >= SHINGLE, per_text - SHINGLE + 1, np.minimum(per_text, 1))
    at = ragged(word[:-1], shingles)
    last = at + np.repeat(np.minimum(per_text, SHINGLE), shingles) - 1
    return joined.tobytes(), out[at], out[last + 1] - 1, np.repeat(np.arange(len(offsets) - 1), shingles)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprint of every text: a bit is set if more than half the shingle hashes have it."""
    n = len(offsets) - 1
    joined, start, end, owner = shingle_spans(data, offsets)
    ones = np.zeros((n, 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, len(start), BLOCK):
        spans = zip(start[lo : lo + BLOCK].tolist(), end[lo : lo + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], U64)
        who = owner[lo : lo + BLOCK]
        new = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[who[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    total = np.bincount(owner, minlength=n)
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(U64).ravel()


def _fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id and fp of every row (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            found = [fingerprints(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)]
            fp = np.concatenate(found) if found else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.mapInArrow(run, "doc_id long, fp long")


def _segment(fp: np.ndarray, k: int) -> np.ndarray:
    return (fp >> U64(_AT[k])) & U64((1 << _WIDTH[k]) - 1)


def _chain_mask(k: int, length: int) -> np.uint64:
    """Bits of the chain of `length` segments from segment k on, around the ring."""
    return U64(sum(((1 << _WIDTH[j % SEGMENTS]) - 1) << _AT[j % SEGMENTS] for j in range(k, k + length)))


def chain_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the fingerprint, bucket and whether the bucket is the fingerprint's home, for all chains of two segments.

    A home bucket is named by both segments as they are; a fingerprint also visits the homes whose second segment has
    one more bit set. Of two fingerprints within the budgets of a chain, one is then met in the other's home.
    """
    rows, keys, homes = [], [], []
    everyone = np.arange(len(fp))
    for k in range(SEGMENTS):
        first, second = _segment(fp, k), _segment(fp, (k + 1) % SEGMENTS)
        base = (U64(k) << U64(26)) | (first << U64(13))
        rows.append(everyone)
        keys.append(base | second)
        homes.append(np.ones(len(fp), bool))
        for bit in range(_WIDTH[(k + 1) % SEGMENTS]):
            free = np.flatnonzero((second >> U64(bit)) & U64(1) == 0)
            rows.append(free)
            keys.append((base | second | U64(1 << bit))[free])
            homes.append(np.zeros(len(free), bool))
    return np.concatenate(rows), np.concatenate(keys).astype(np.int64), np.concatenate(homes)


def _placed(distinct: DataFrame) -> DataFrame:
    """key, fp, home: every fingerprint in its home buckets and those that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for lo in range(0, len(fp), 1 << 14):
                part = fp[lo : lo + (1 << 14)]
                row, key, home = chain_keys(part.view(U64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row]), pa.array(home)], names=["key", "fp", "home"])

    return distinct.select("fp").mapInArrow(run, "key long, fp long, home boolean")


def near_pairs(fp: np.ndarray, home: np.ndarray, chunk: np.ndarray, chain: int, apart: bool) -> np.ndarray:
    """Matrix of linked members of one bucket; `apart` leaves out pairs within one chunk, visitors are not compared with each other.

    Chains of three and four segments prune by their budgets before the whole fingerprints are counted.
    """
    out = np.zeros((len(fp), len(fp)), bool)
    for lo in range(0, len(fp), 256):
        differ = fp[lo : lo + 256, None] ^ fp
        wanted = home[lo : lo + 256, None] | home
        if apart:
            wanted &= chunk[lo : lo + 256, None] != chunk
        left = np.flatnonzero(wanted)
        for length in range(3, SEGMENTS + 1):
            bits = np.bitwise_count(differ.ravel()[left] & _chain_mask(chain, length))
            left = left[bits <= length * NEAR // SEGMENTS]
        out[lo : lo + 256].ravel()[left] = True
    np.fill_diagonal(out, False)
    return out


def _trees(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members with a neighbour, and the first member of each one's component; every row of the matrix is read once."""
    root = np.full(len(near), -1)
    for k in np.flatnonzero(near.any(1)):
        if root[k] >= 0:
            continue
        root[k], front = k, np.array([k])
        while len(front):
            front = np.flatnonzero(near[front].any(0) & (root < 0))
            root[front] = k
    held = np.flatnonzero(root >= 0)
    return held, root[held]


def _edges(rows: DataFrame) -> DataFrame:
    """a, b: for every bucket part (key, low, high) the members that links connect, each with one member of its tree."""

    def solve(t: pa.Table, key: int, apart: bool) -> pa.RecordBatch | None:
        fp, home, chunk = t["fp"].to_numpy(), t["home"].to_numpy(zero_copy_only=False), t["chunk"].to_numpy()
        held, root = _trees(near_pairs(fp.view(U64), home, chunk, key >> 26, apart))
        below = held != root
        if not below.any():
            return None
        return pa.RecordBatch.from_arrays([pa.array(fp[held[below]]), pa.array(fp[root[below]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([*held, batch]).combine_chunks()
            name = np.stack([t[c].to_numpy() for c in ("key", "low", "high")])
            cuts = np.append(0, np.flatnonzero((name[:, 1:] != name[:, :-1]).any(0)) + 1)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a > 1 and (out := solve(t.slice(a, b - a), int(name[0, a]), name[1, a] != name[2, a])) is not None:
                    yield out
            held = t.slice(cuts[-1]).combine_chunks().to_batches()  # the last bucket may go on
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            if (out := solve(t, t["key"][0].as_py(), t["low"][0].as_py() != t["high"][0].as_py())) is not None:
                yield out

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.select("key", "low", "high", "chunk", "fp", "home").repartition(n, "key", "low", "high").sortWithinPartitions("key", "low", "high")
    return ordered.mapInArrow(run, "a long, b long")


def linked_fingerprints(distinct: DataFrame, work: WorkTables) -> DataFrame:
    """node, root of the components that links of the distinct fingerprints (fp) make; fingerprints without a link are left out."""
    placed = work.store(_placed(distinct), "buckets")
    sizes = placed.groupBy("key").agg(F.count("*").alias("n"), F.max("home").alias("lived_in")).filter("n > 1 and lived_in").select("key", "n")
    # sizes are stored before they are joined back, so that Spark may split the join where a bucket is hot
    met = placed.join(work.store(sizes, "sizes"), "key")
    parts = met.withColumn("k", F.ceil(F.col("n") / CHUNK).cast("int")).withColumn("chunk", F.pmod(F.xxhash64("fp", "key"), F.col("k")).cast("int"))
    chunks = parts.select("key", "fp", "home", "chunk", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    paired = chunks.select("key", "fp", "home", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    return components(_edges(paired))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id and copies of every row of `docs`.

    Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a shingle is four of them joined by spaces, all of them where
    a text has fewer, none where it has none or is null (fingerprint zero). Rows whose fingerprints differ in at most
    NEAR bits are linked; component_id is the least doc_id that links lead to (null if no row of the component has
    one). copies counts the rows with the same fingerprint. Rows with a null id, and repeated rows, are rows as any
    other; an empty table gives no rows; other columns are ignored.
    """
    work = WorkTables(docs.sparkSession, "simhash")
    rows = work.store(_fingerprinted(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))), "fingerprints")
    distinct = work.store(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "distinct")
    roots = linked_fingerprints(distinct, work)
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", "copies", F.coalesce("root", "fp").alias("root"))
    rooted = work.store(rooted, "rooted")
    named = work.store(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    classes = work.store(rooted.join(named, "root").select("fp", "component_id", "copies"), "classes")
    work.drop(rows, classes)
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "copies"
    )
