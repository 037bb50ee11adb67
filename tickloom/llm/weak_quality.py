"""Quality classifier from weak labels.

Heuristic labellers vote on every text or abstain. Their votes are counted by pattern over all texts; expectation
maximisation on those counts estimates how often each labeller is right, and the posterior of a pattern is the label of
its texts. A linear scorer over hashed byte trigrams and votes learns these labels and judges every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.arrays import (
    U64, carried, carried_columns, carried_field, mix, prefix_hash, ragged, shingles, slices, span_hash, text_bytes, words,
)

#: Texts that the scorer is fitted on, at most about; chosen by hash.
FIT_ROWS = 2048
#: Hash buckets of trigrams, learning steps and step size.
BUCKETS, STEPS, RATE = 1 << 13, 150, 0.3
#: Variety is judged in blocks of at most so many words, and longer texts by repeated windows of so many words besides.
BLOCK, WINDOW = 1000, 8
#: Rounds of expectation maximisation; accuracy that labellers start with, and votes that this counts for.
ROUNDS, START, SMOOTH = 30, 0.9, 10.0

_UPPER, _LOWER, _SPACE, _SYMBOL, _SHOUT, _DIGIT, _LINE, _OTHER = range(8)
_KIND = np.full(256, _LOWER, np.uint8)
_KIND[:128] = _OTHER
_KIND[65:91], _KIND[97:123], _KIND[48:58] = _UPPER, _LOWER, _DIGIT
_KIND[[9, 11, 12, 13, 32]], _KIND[10] = _SPACE, _LINE
_KIND[list(b"#*$%&|<>")], _KIND[list(b"!?")] = _SYMBOL, _SHOUT



def _plain(s: dict[str, np.ndarray]) -> np.ndarray:
    """No signs or shouting, few capitals: the characters of ordinary prose."""
    return (s["symbol"] == 0) & (s["shout"] < 0.05) & (s["upper"] < 0.12) & (s["digit"] < 0.1)


#: Each votes poor (1), good (-1) or abstains (0) on the statistics of many texts. Those for poor look for one fault each
#: and know nothing of the others, so they abstain where it is missing; those for good look at all of a kind.
LABELLERS = (
    ("capitals", lambda s: np.where((s["letters"] >= 40) & (s["upper"] > 0.5), 1, 0)),
    ("shouting", lambda s: np.where((s["words"] >= 10) & (s["shout"] > 0.4), 1, 0)),
    ("symbols", lambda s: np.where((s["words"] >= 2) & (s["symbol"] * s["words"] >= 2) & (s["symbol"] > 0.2), 1, 0)),
    ("digits", lambda s: np.where((s["words"] >= 10) & (s["digit"] > 0.4), 1, 0)),
    ("repeated_words", lambda s: np.where((s["words"] >= 30) & (s["distinct"] < s["expected"] * 0.6), 1, 0)),
    ("echo", lambda s: np.where((s["words"] >= 20) & (s["echo"] > 0.2), 1, 0)),
    ("repeated_lines", lambda s: np.where((s["lines"] >= 3) & (s["repeats"] > 0.34), 1, 0)),
    ("plain_prose", lambda s: np.where((s["words"] >= 20) & _plain(s), -1, 0)),
    ("varied_words", lambda s: np.where((s["words"] >= 20) & (s["symbol"] < 0.05) & (s["upper"] < 0.3) & (s["distinct"] > s["expected"] * 0.75), -1, 0)),
)


def _distinct(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each of n groups."""
    order = np.lexsort((values, group))
    v, g = values[order], group[order]
    new = np.append(True, (v[1:] != v[:-1]) | (g[1:] != g[:-1]))[: len(v)]
    return np.bincount(g[new], minlength=n)


def _variety(hashes: np.ndarray, word_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of each text as a share, and the share that prose has.

    Prose uses fewer new words the longer it is, so a text is cut into equal blocks of at most BLOCK words, whose shares
    are averaged over the whole text. What repeats from block to block counts by the windows of WINDOW words that stood
    in the text before, rare in prose of any length: the share is lowered by theirs.
    """
    n, count = len(word_at) - 1, np.diff(word_at)
    blocks = np.maximum(1, -(-count // BLOCK))
    first = np.append(0, np.cumsum(blocks))
    owner = np.repeat(np.arange(n), count)
    within = np.arange(len(hashes)) - word_at[:-1][owner]
    block = first[owner] + within * blocks[owner] // np.maximum(count, 1)[owner]
    distinct = np.add.reduceat(_distinct(hashes, block, first[-1]), first[:-1]) if n else np.zeros(0, np.int64)
    share = distinct / np.maximum(count, 1)
    long = np.flatnonzero(blocks > 1)
    if len(long):
        grams, gram_at = shingles(hashes[ragged(word_at[:-1][long], count[long])], np.append(0, np.cumsum(count[long])), WINDOW)
        per = np.diff(gram_at)
        share[long] *= _distinct(grams, np.repeat(np.arange(len(long)), per), len(long)) / per
    return share, np.minimum(1.0, 1.15 - 0.065 * np.log(np.maximum(count / blocks, 1)))


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """What the labellers look at, for each text."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(row * 8 + _KIND[data], minlength=n * 8).reshape(n, 8)
    hashes, _, _, word_at = words(data, offsets)
    count = np.diff(word_at)
    owner = np.repeat(np.arange(n), count)
    distinct, expected = _variety(hashes, word_at)
    echo = np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=n) if len(owner) else np.zeros(n)
    # lines that are not empty, by hash
    breaks = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    start = start[start < len(data)]
    stop = np.minimum(np.append(start[1:], len(data)), len(data))
    stop = stop - ((stop > start) & (data[stop - 1] == 10)) if len(start) else start
    full = stop > start
    start, stop = start[full], stop[full]
    line = span_hash(prefix_hash(data), start, stop) if len(start) else np.zeros(0, U64)
    at = np.searchsorted(offsets, start, side="right") - 1
    lines = np.bincount(at, minlength=n)
    letters = kinds[:, _UPPER] + kinds[:, _LOWER]
    per = lambda a, b: a / np.maximum(b, 1)
    return {
        "letters": letters, "words": count, "upper": per(kinds[:, _UPPER], letters), "symbol": per(kinds[:, _SYMBOL], count),
        "shout": per(kinds[:, _SHOUT], count), "digit": per(kinds[:, _DIGIT], np.diff(offsets)), "distinct": distinct, "expected": expected,
        "lines": lines, "repeats": per(lines - _distinct(line, at, n), lines), "echo": per(echo, count),
    }


def votes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, labellers) votes."""
    s = statistics(data, offsets)
    return np.stack([vote(s) for _, vote in LABELLERS], 1).astype(np.int8)


def pattern(v: np.ndarray) -> np.ndarray:
    """Votes as one number, a base-3 digit for each labeller."""
    return (v.astype(np.int64) + 1) @ (3 ** np.arange(v.shape[1]))


def unpattern(numbers: np.ndarray, labellers: int) -> np.ndarray:
    return (numbers[:, None] // 3 ** np.arange(labellers) % 3 - 1).astype(np.int8)


def posterior_of(v: np.ndarray, accuracy: np.ndarray) -> np.ndarray:
    """How likely texts with these votes are poor; 0.5 without votes."""
    return 1 / (1 + np.exp(-(v @ np.log(accuracy / (1 - accuracy)))))


def estimate(numbers: np.ndarray, counts: np.ndarray, labellers: int = len(LABELLERS)) -> tuple[np.ndarray, np.ndarray]:
    """Accuracy of every labeller where it votes, and posterior (of being poor) of every vote pattern, from the patterns' counts.

    Labellers are taken to err independently; on texts with votes both classes are equally likely beforehand.
    """
    v, w = unpattern(numbers, labellers), counts.astype(float)
    accuracy = np.full(labellers, START)
    for _ in range(ROUNDS):
        posterior = posterior_of(v, accuracy)
        right = posterior * w @ (v > 0) + (1 - posterior) * w @ (v < 0)
        total = w @ (v != 0)
        accuracy = np.clip((right + START * SMOOTH) / (total + SMOOTH), 0.55, 0.995)
    return accuracy, posterior_of(v, accuracy)


def features(data: np.ndarray, offsets: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (row, bucket, value): root shares of hashed byte trigrams, and a bucket for each vote."""
    n = len(offsets) - 1
    if len(data) > 2:
        code = data[:-2].astype(U64) << U64(16) | data[1:-1].astype(U64) << U64(8) | data[2:].astype(U64)
        bucket = (mix(code + U64(1)) % U64(BUCKETS)).astype(np.int64)
        row = np.searchsorted(offsets, np.arange(len(code)), side="right") - 1
        inside = np.arange(len(code)) + 2 < offsets[row + 1]
        key, count = np.unique(row[inside] * BUCKETS + bucket[inside], return_counts=True)
        row, bucket = key // BUCKETS, key % BUCKETS
        value = np.sqrt(count / np.maximum(1, np.diff(offsets)[row] - 2))
    else:
        row, bucket, value = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    who, which = np.nonzero(v)
    votes_at = BUCKETS + 2 * which + (v[who, which] > 0)
    return np.concatenate([row, who]), np.concatenate([bucket, votes_at]), np.concatenate([value, np.full(len(who), 0.5)])


WIDTH = BUCKETS + 2 * len(LABELLERS) + 1


def fit(row: np.ndarray, bucket: np.ndarray, value: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Weights of a logistic scorer for soft targets; both classes weigh the same, the last weight is the constant."""
    n = len(target)
    weight = np.zeros(WIDTH)
    if n == 0:
        return weight
    poor = np.clip(target.sum(), 1, None)
    balance = target / poor + (1 - target) / np.clip((1 - target).sum(), 1, None)
    balance *= np.abs(2 * target - 1) / 2
    scale = np.zeros(WIDTH) + 1e-8
    for _ in range(STEPS):
        score = np.bincount(row, value * weight[bucket], n) + weight[-1]
        error = (1 / (1 + np.exp(-score)) - target) * balance
        gradient = np.bincount(bucket, value * error[row], WIDTH) + 1e-6 * weight
        gradient[-1] = error.sum()
        scale += gradient**2
        weight -= RATE * gradient / np.sqrt(scale)
    return weight


def _pairs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def _sample(texts: DataFrame, rows: int) -> DataFrame:
    """FIT_ROWS texts at most, `fit` set: different ones, with the least hashes of those below a bound that some FIT_ROWS of `rows` meet.

    Copies fall together by the hash of the whole text before the limit, so a table of copies, or of texts that open
    alike, gives no more rows than another.
    """
    bound = int(min(1.0, FIT_ROWS / max(1, rows)) * (1 << 62))
    hashed = texts.select(F.pmod(F.xxhash64("text"), F.lit(1 << 62)).alias("hash"), "text").filter(F.col("hash") < bound)
    return hashed.dropDuplicates(["hash"]).orderBy("hash").limit(FIT_ROWS).select("text", F.lit(True).alias("fit"))


def _patterns(texts: DataFrame) -> DataFrame:
    """pattern of every text, and its features where `fit` is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            wanted = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi in slices(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                v = votes(part, at)
                rows: list[bytes | None] = [None] * (hi - lo)
                for k in np.flatnonzero(wanted[lo:hi]):
                    _, bucket, value = features(part[at[k] : at[k + 1]], at[k : k + 2] - at[k], v[k : k + 1])
                    rows[k] = np.stack([bucket.astype("<f4"), value.astype("<f4")]).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(pattern(v)), pa.array(rows, pa.binary())], names=["pattern", "features"])

    return texts.mapInArrow(run, "pattern long, features binary")


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_votes, posterior (of the label model), score (of the scorer, 0 to 1), rejected and carried of every row.

    carried is the struct of the columns `carry`, unchanged.

    Rejected is a text that the scorer gives more than 0.5 and the label model does not call good. The label model counts
    the votes on all texts; the scorer is fitted on at most FIT_ROWS different texts chosen by hash, as many at every size of
    table; texts with one hash count once. A null text is empty: nobody votes on it and it is not rejected; nor is any text
    on which no labeller votes. Repeated rows and null ids are returned as they come; an empty table gives no rows; other columns
    are ignored.
    """
    spark, texts = docs.sparkSession, _pairs(docs, id_col, text_col)
    rows = sorted(_patterns(texts.select("text", F.lit(False).alias("fit"))).groupBy("pattern").agg(F.count("*").alias("n")).collect())
    numbers, counts = np.array([r["pattern"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)
    accuracy, _ = estimate(numbers, counts)
    fitted = _patterns(_sample(texts, int(counts.sum())))
    sample = sorted((r["pattern"], bytes(r["features"])) for r in fitted.collect())
    sparse = [np.frombuffer(x, "<f4").reshape(2, -1) for _, x in sample] or [np.zeros((2, 0))]
    soft = posterior_of(unpattern(np.array([p for p, _ in sample], np.int64), len(LABELLERS)), accuracy)
    bucket, value = np.concatenate(sparse, 1)
    row = np.repeat(np.arange(len(sparse)), [x.shape[1] for x in sparse])
    weight = fit(row, bucket.astype(np.int64), value.astype(float), soft)
    model = spark.sparkContext.broadcast((accuracy, weight))  # an accuracy for each labeller, WIDTH weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accuracy, weight = model.value
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                v = votes(part, at)
                row, bucket, value = features(part, at, v)
                score = 1 / (1 + np.exp(-(np.bincount(row, value * weight[bucket], hi - lo) + weight[-1])))
                n_votes = (v != 0).sum(1)
                judged = posterior_of(v, accuracy)
                rest = carried(batch, carry, text_col, lo, hi)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), pa.array(n_votes, pa.int64()),
                        pa.array(judged), pa.array(score),
                        pa.array((score > 0.5) & (n_votes > 0) & (judged >= 0.5)), rest,
                    ],
                    names=["doc_id", "n_votes", "posterior", "score", "rejected", "carried"],
                )

    found = StructType.fromDDL("n_votes long, posterior double, score double, rejected boolean")
    whole = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *carried_columns(carry, text_col))
    return whole.mapInArrow(run, StructType([whole.schema["doc_id"], *found.fields, carried_field(docs, carry)]))
