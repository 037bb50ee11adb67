"""Phrase collocations from an FM-index per shard over word ids.

A shard is a few megabytes of text of one language: its words as local ids, pieces set apart by id 0. It is indexed by two
Burrows-Wheeler transforms, `behind` (the word before each suffix) and `ahead` (the word after each reversed prefix), both
sorted by DEPTH words, which is all that phrases of DEPTH + 1 words need. A phrase is a pair of intervals, one in each
order; extending it by a word on one side reads that side's transform and keeps the interval of the other in step.

Phrases grow by one word a round, to the right and to the left in turn. In every shard the intervals of phrases that are
frequent in the whole corpus are extended; an extension is counted only if its other end is frequent too. Counts of all
shards are summed by range of hashes, in blocks of packed columns (a fraction of the size of rows), and what reaches the
least count goes back to the shards that hold it. Ranges grow in number with the corpus, so one is a bounded group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.arrays import U64, mix, prefix_hash, ragged, span_hash, text_bytes
from tickloom.llm.packed import dealt, expand, pack, squeeze, unpack
from tickloom.llm.work import WorkTables

#: Words of a phrase at most, and the words that suffixes are sorted by.
LONGEST = 5
DEPTH = LONGEST - 1
LEAST_COUNT = 100
TOP = 2000
#: Words of the corpus per range of hashes in which counts of shards are summed; a range of phrases is one group.
RANGE_WORDS = 4 << 20
#: Bytes of text of a shard; one longer piece without any separator makes a longer shard.
SHARD_BYTES = 12 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPLITS = np.zeros(256, bool)
_SPLITS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IS_WORD = ~_SPLITS
_IS_WORD[[0x20, 0x09]] = False

SHARD = "shard long, lang string, n_words long, n_ids int, ahead binary, behind binary, words array<string>, starts array<int>, counts array<int>"
#: What a range of hashes gives back. For each shard, packed: interval starts f (suffixes) and r (reversed prefixes), width and
#: number of the phrases that are frequent in the corpus. Once, without a shard: all these phrases with their counts.
FREQUENT = "shard long, numbers binary, phrases array<struct<phrase: long, a: long, {}>>"


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Local word ids (from 1) of all texts, 0 before, between and after pieces, and the words by id - 1."""
    low = _LOWER[data]
    inside = _IS_WORD[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begins[first] = inside[first]
    start = np.flatnonzero(begins)
    if not len(start):
        return np.zeros(1, np.int32), pa.array([], pa.string())
    run = np.cumsum(inside)
    at = np.append(run[start] - 1, run[-1])
    spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(low[inside])])
    coded = spelled.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
    marks = np.cumsum(_SPLITS[low])[start] + np.searchsorted(offsets, start, side="right")
    cuts = np.flatnonzero(np.append(True, marks[1:] != marks[:-1]))
    return np.append(np.insert(ids, cuts, 0), np.int32(0)), coded.dictionary.cast(pa.large_string()).cast(pa.string())


def _order(ids: np.ndarray) -> np.ndarray:
    """Positions sorted by the DEPTH ids from each on; past the end stands 0."""
    rank, span = ids.astype(np.int64), 1
    while True:
        after = np.zeros_like(rank)
        after[:-span] = rank[span:]
        key = rank * (int(rank.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        span *= 2
        if span >= DEPTH:
            return order
        key = key[order]
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(np.append(False, key[1:] != key[:-1]))


def transforms(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word behind each position in the order of suffixes, and the word ahead in the order of reversed prefixes."""
    order = _order(ids)
    behind = np.append(np.int32(0), ids[:-1])[order]
    back = ids[::-1]
    return behind, np.append(np.int32(0), back[:-1])[_order(back)]


def extend(bwt: np.ndarray, n_ids: int, own: np.ndarray, other: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, ...]:
    """All extensions of phrases by one word on the side of `bwt`: phrase, interval starts on this and the other side, count.

    `own` are the interval starts in the order of `bwt`, `other` those in the other order.
    """
    # where an occurrence of a word leads to: all smaller words first, then its own ones before it
    steps = np.empty(len(bwt), np.int64)
    steps[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    at = ragged(own, width)
    key = np.repeat(np.arange(len(own)), width) * (n_ids + 1) + bwt[at]
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    phrase, held = key[new] // (n_ids + 1), key[new] % (n_ids + 1) > 0
    before = new - np.append(0, np.cumsum(width))[phrase]  # occurrences beside smaller words
    count = np.diff(np.append(new, len(key)))
    return phrase[held], steps[at[order[new]]][held], (other[phrase] + before)[held], count[held]


def within(starts: np.ndarray, widths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the disjoint intervals, sorted by start, holds each position; -1 for none."""
    if not len(starts):
        return np.full(len(at), -1)
    k = np.searchsorted(starts, at, side="right") - 1
    return np.where((k >= 0) & (at < starts[k] + widths[k]), k, -1)


def _texts(column: pa.Array, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts as bytes and offsets, at most `most` bytes at a time; longer ones are cut where pieces end."""
    data, offsets = text_bytes(column)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        begin, stop = int(offsets[lo]), int(offsets[hi])
        while stop - begin > most:  # one long text
            cuts = np.flatnonzero(_SPLITS[data[begin : begin + most]])
            if not len(cuts):
                cuts = np.flatnonzero(_SPLITS[data[begin:stop]])[:1]
            if not len(cuts):
                break
            end = begin + int(cuts[-1]) + 1
            yield data[begin:end], np.array([0, end - begin])
            begin = end
        yield data[begin:stop], (offsets[lo : hi + 1] - begin if hi - lo > 1 else np.array([0, stop - begin]))
        lo = hi


def _shards(docs: DataFrame) -> DataFrame:
    """One indexed shard per row, from rows (lang, text); shards are numbered by the task and their place in it."""

    def index(number: int, lang: str, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        sizes = [len(d) for d, _ in parts]
        data = np.concatenate([d for d, _ in parts])
        base = np.append(0, np.cumsum(sizes))
        offsets = np.concatenate([o[:-1] + b for (_, o), b in zip(parts, base[:-1], strict=True)] + [base[-1:]])
        ids, words = word_ids(data, offsets)
        behind, ahead = transforms(ids)
        counts = np.bincount(ids, minlength=len(words) + 1)
        starts, counts = np.cumsum(counts)[:-1], counts[1:]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number]), pa.array([lang]), pa.array([int(counts.sum())]), pa.array([len(words)], pa.int32()),
                pa.array([pack(ahead)], pa.binary()), pa.array([pack(behind)], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                *(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(c.astype(np.int32))) for c in (starts, counts)),
            ],
            names=["shard", "lang", "n_words", "n_ids", "ahead", "behind", "words", "starts", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 20
        open_: dict[str, list] = {}
        size: dict[str, int] = {}

        def close(lang: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            size.pop(lang)
            return index(number, lang, open_.pop(lang))

        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                for data, offsets in _texts(batch.column(1).filter(pc.equal(batch.column(0), lang)), SHARD_BYTES):
                    if lang in open_ and size[lang] + len(data) > SHARD_BYTES:
                        yield close(lang)
                    open_.setdefault(lang, []).append((data, offsets))
                    size[lang] = size.get(lang, 0) + len(data)
            while sum(size.values()) > 2 * SHARD_BYTES:  # many languages at once: index the fullest
                yield close(max(size, key=size.get))
        for lang in list(open_):
            yield close(lang)

    return docs.mapInArrow(run, SHARD)


def _given_back(shard: np.ndarray, f: np.ndarray, r: np.ndarray, w: np.ndarray, phrase: np.ndarray, phrases: pa.StructArray) -> pa.Table:
    """Rows of FREQUENT from the frequent occurrences of a range and its phrases."""
    numbers = [(k, pack(f[at], r[at], w[at], phrase[at])) for k, at in dealt(shard)]
    lists = pa.ListArray.from_arrays(pa.array([*[None] * len(numbers), 0, len(phrases)], pa.int32()), phrases)
    return pa.Table.from_arrays([pa.array([*(k for k, _ in numbers), None], pa.int64()), pa.array([*(b for _, b in numbers), None], pa.binary()), lists], names=["shard", "numbers", "phrases"])


def _phrases(frequent: DataFrame) -> DataFrame:
    return frequent.filter("shard IS NULL").select(F.inline("phrases"))


def _spelled(shards: DataFrame, ranges: int) -> DataFrame:
    """Words of every shard with interval starts and counts, packed by range of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, lang = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                words, starts, counts = (batch.column(k)[row].values for k in (2, 3, 4))
                data, offsets = text_bytes(words)
                hashes = span_hash(prefix_hash(data), offsets[:-1], offsets[1:])
                by_name = pc.sort_indices(words).to_numpy()
                blocks = []
                for k, at in dealt((hashes % U64(ranges)).astype(np.int64)[by_name]):
                    at = by_name[at]
                    spelled = "\n".join(words.take(pa.array(at)).to_pylist()).encode()  # no word has a line feed
                    numbers = pack(starts.to_numpy()[at], counts.to_numpy()[at])
                    blocks.append((k, shard, lang, squeeze(spelled), numbers))
                yield pa.RecordBatch.from_pylist([dict(zip(("range", "shard", "lang", "words", "numbers"), b, strict=True)) for b in blocks], schema=schema)

    schema = pa.schema([("range", pa.int64()), ("shard", pa.int64()), ("lang", pa.string()), ("words", pa.binary()), ("numbers", pa.binary())])
    return shards.select("shard", "lang", "words", "starts", "counts").mapInArrow(run, "range long, shard long, lang string, words binary, numbers binary")


def _frequent_words(blocks: DataFrame, least: int) -> DataFrame:
    """Words with at least `least` occurrences over all shards; see FREQUENT."""

    def run(group: pa.Table) -> pa.Table:
        out, known = [], group["range"][0].as_py() << 32
        langs = group["lang"].to_pylist()
        names = {"phrase": [], "a": [], "lang": [], "word": []}
        for lang in sorted(set(langs)):
            rows = [k for k, x in enumerate(langs) if x == lang]
            words = [expand(group["words"][k].as_py()).split(b"\n") for k in rows]
            start, count = (np.concatenate(x) for x in zip(*(unpack(group["numbers"][k].as_py(), 2) for k in rows), strict=True))
            shard = np.repeat([group["shard"][k].as_py() for k in rows], [len(w) for w in words])
            coded = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode()
            word = coded.indices.to_numpy().astype(np.int64)
            total = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(total, word, count)
            held = total[word] >= least
            out.append((shard[held], start[held], start[held], count[held], known + word[held]))
            often = np.flatnonzero(total >= least)
            names["phrase"] += (known + often).tolist()
            names["a"] += total[often].tolist()
            names["lang"] += [lang] * len(often)
            names["word"] += [w.decode() for w in coded.dictionary.take(pa.array(often)).to_pylist()]
            known += len(coded.dictionary)
        kinds = {"phrase": pa.int64(), "a": pa.int64(), "lang": pa.string(), "word": pa.string()}
        phrases = pa.StructArray.from_arrays([pa.array(names[c], t) for c, t in kinds.items()], names=list(kinds))
        return _given_back(*(np.concatenate(x) for x in zip(*out, strict=True)), phrases)

    return blocks.groupBy("range").applyInArrow(run, FREQUENT.format("lang: string, word: string"))


def _extended(shards: DataFrame, alive: DataFrame, right: bool, ranges: int) -> DataFrame:
    """Occurring extensions, by one word to the right or left, of the frequent phrases `alive` of every shard, packed by range of their hashes."""
    schema = pa.schema([("range", pa.int64()), ("shard", pa.int64()), ("numbers", pa.binary())])

    def run(left: pa.Table, rows: pa.Table) -> pa.Table:
        if not left.num_rows or not rows.num_rows:
            return schema.empty_table()
        f, r, w, name = (np.concatenate(x) for x in zip(*(unpack(b, 4) for b in rows["numbers"].to_pylist()), strict=True))
        own, other = (r, f) if right else (f, r)
        order = np.argsort(own)
        own, other, w, name = own[order], other[order], w[order], name[order]
        phrase, start, beside, count = extend(unpack(left["bwt"][0].as_py())[0], left["n_ids"][0].as_py(), own, other, w)
        # the other end of the extension is a phrase of the old length: frequent if its interval is among those on this side
        end = within(own, w, start)
        held = np.flatnonzero(end >= 0)
        here, there = name[phrase[held]], name[end[held]]
        prefix, suffix = (here, there) if right else (there, here)
        hashes = mix(prefix.view(U64) + mix(suffix.view(U64)))
        columns = [*((beside[held], start[held]) if right else (start[held], beside[held])), count[held], prefix, suffix]
        blocks = [(k, pack(*(c[at] for c in columns))) for k, at in dealt((hashes % U64(ranges)).astype(np.int64))]
        shard = left["shard"][0].as_py()
        return pa.Table.from_pylist([{"range": k, "shard": shard, "numbers": b} for k, b in blocks], schema=schema)

    index = shards.select("shard", "n_ids", F.col("ahead" if right else "behind").alias("bwt"))
    held = alive.filter("shard IS NOT NULL").select("shard", "numbers").groupBy("shard")
    return index.groupBy("shard").cogroup(held).applyInArrow(run, "range long, shard long, numbers binary")


def _frequent_phrases(blocks: DataFrame, least: int) -> DataFrame:
    """Phrases with at least `least` occurrences over all shards; see FREQUENT."""

    def run(group: pa.Table) -> pa.Table:
        parts = [unpack(b, 5) for b in group["numbers"].to_pylist()]
        shard = np.repeat(group["shard"].to_numpy(), [len(p[0]) for p in parts])
        f, r, w, prefix, suffix = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.lexsort((suffix, prefix))
        new = np.append(True, (np.diff(prefix[order]) != 0) | (np.diff(suffix[order]) != 0))
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        total = np.zeros(int(new.sum()), np.int64)
        np.add.at(total, which, w)
        often = total >= least
        name = (group["range"][0].as_py() << 32) + np.cumsum(often)
        held, first = often[which], order[new][often]
        phrases = pa.StructArray.from_arrays([pa.array(c) for c in (name[often], total[often], prefix[first], suffix[first])], names=["phrase", "a", "prefix", "suffix"])
        return _given_back(shard[held], f[held], r[held], w[held], name[which[held]], phrases)

    return blocks.groupBy("range").applyInArrow(run, FREQUENT.format("prefix: long, suffix: long"))


def _scored(phrases: DataFrame, length: int) -> DataFrame:
    """Phrases with l, r and score of their lowest-scoring cut; ties go to the first."""
    wide = lambda c: c.cast("decimal(38,0)")

    def cut(k: int) -> Column:
        l, r = F.element_at("heads", k), F.element_at("tails", length - k)
        top = wide(F.col("a").cast("decimal(18,0)") * F.lit(1000).cast("decimal(4,0)")) * F.col("n").cast("decimal(16,0)")
        return F.struct(F.call_function("div", wide(top), wide(l.cast("decimal(18,0)") * r.cast("decimal(18,0)"))).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))

    cuts = [cut(k) for k in range(1, length)]
    best = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return phrases.withColumn("best", best).select("lang", F.array_join("words", " ").alias("phrase"), "a", "best.l", "best.r", "n", "best.score")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT, top: int | None = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases of two to LONGEST words that stand together most, per language.

    Texts are lower-cased in A-Z, cut into pieces at `[.,;:!?\\x0A-\\x0D]` and those into words `[^\\x20\\x09]+`. n counts the
    words of the language, a the occurrences of the phrase inside pieces (overlaps included), at least `least`. l and r count
    the two parts of the cut with the least floor(1000 * a * n / (l * r)), the first of such cuts; that is the score. A phrase inside a
    longer one of at most LONGEST words with as many occurrences is left out. Rank follows score, a (both descending)
    and the phrase (bytes); `top` keeps the first ranks, None all. A null language is `und`, a null text empty; repeated
    rows count as often as they stand; an empty table gives no rows; other columns are ignored.
    """
    work = WorkTables(docs.sparkSession, "collocations")
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shards = work.store(_shards(source), "shards")
    totals = work.store(shards.groupBy("lang").agg(F.sum("n_words").alias("n")), "totals")

    ranges = max(1, -(-(totals.agg(F.sum("n")).first()[0] or 0) // RANGE_WORDS))
    alive = work.store(_frequent_words(_spelled(shards, ranges), least), "words")
    known = _phrases(alive).select("phrase", "lang", F.array("word").alias("words"), F.array("a").alias("heads"), F.array("a").alias("tails"), "a")

    scored, tables = [], [known]
    for length in range(2, LONGEST + 1):
        alive = work.store(_frequent_phrases(_extended(shards, alive, length % 2 == 0, ranges), least), f"phrases-{length}")
        first, last = tables[-1].alias("p"), tables[-1].alias("s")
        rows = _phrases(alive).alias("x")
        joined = rows.join(first, F.col("x.prefix") == F.col("p.phrase")).join(last, F.col("x.suffix") == F.col("s.phrase")).select(
            "x.phrase", "x.prefix", "x.suffix", "p.lang", F.concat("p.words", F.slice("s.words", -1, 1)).alias("words"),
            F.concat("p.heads", F.array("x.a")).alias("heads"), F.concat("s.tails", F.array("x.a")).alias("tails"), "x.a",
        )
        tables.append(work.store(joined, f"table-{length}"))
    for length, (phrases, longer) in enumerate(zip(tables[1:], [*tables[2:], None], strict=True), start=2):
        kept = phrases
        if longer is not None:  # a longer phrase with as many occurrences holds one of this length, plus a word, with as many
            whole = longer.select(F.explode(F.array("prefix", "suffix")).alias("inner"), F.col("a").alias("as_many"))
            kept = phrases.join(whole, (phrases["phrase"] == whole["inner"]) & (phrases["a"] == whole["as_many"]), "left_anti")
        scored.append(_scored(kept.join(totals, "lang"), length))
    ranked = reduce(DataFrame.unionByName, scored)
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(by))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    out = ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *(F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")))
    result = work.store(out, "ranked")
    work.drop(result)
    return result
