"""N-gram Jaccard self join of texts by chosen paths.

A text is its set of shingles of SHINGLE words. In each of RUNS runs a set chooses some of its shingles by hash, the same
ones in every set that has them; each choice is a path, and sets that chose the same path meet in its bucket. Buckets
of at most SMALL sets are compared by brute force. In a larger bucket a sample tells whether its sets are mostly alike:
if so they are compared too, in chunks; if not, its sets choose again inside the bucket, up to DEPTH choices, so that
sets that only share a common passage part ways. What is still crowded then is compared in chunks all the same.

A pair of similarity 0.8 shares about 1.8 choices a run, so all runs miss it with a probability of some e**-9 (0.0014 at
most where every shared choice is crowded). Every pair found is verified on the whole sets, with integers, and counted in
the first bucket that both its sets are in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.arrays import U64, mix, shingles, slices, text_bytes, words
from tickloom.llm.components import components
from tickloom.session import remove_path, work_path

SHINGLE = 5
#: Similarity at least NEAR[0] / NEAR[1].
NEAR = (4, 5)
RUNS, DEPTH, SMALL, CHUNK = 5, 4, 64, 512
#: Choices per set and step, as a multiple of one choice per similar pair.
BOOST = 2.0
#: Sets of a crowded bucket that are sampled, and the share of alike pairs that makes it dense.
SAMPLE, DENSE = 32, 0.2
#: Bytes of a sketch; sets of fewer shingles are not judged by it.
BINS, SKETCH_LEAST = 64, 48

_SEEDS = mix(np.arange(1, RUNS + 1, dtype=U64) * U64(0xA24BAED4963EE407))


def _limits(sizes: np.ndarray) -> np.ndarray:
    """Hash values below which a set of this size chooses a shingle."""
    near = 2 * NEAR[0] / (NEAR[0] + NEAR[1])  # of two sets of one size with the least similarity, the share in common
    rate = np.minimum(1.0, BOOST / (near * np.maximum(sizes, 1)))
    return np.minimum(rate * 2.0**64, 2.0**64 - 2048).astype(U64)


def token_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, and the n + 1 offsets."""
    hashes, _, _, word_at = words(data, offsets)
    grams, gram_at = shingles(hashes, word_at, SHINGLE)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(gram_at))
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.append(True, (grams[1:] != grams[:-1]) | (row[1:] != row[:-1]))[: len(grams)]
    return grams[new], np.append(0, np.cumsum(np.bincount(row[new], minlength=len(offsets) - 1)))


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values, dtype=U64, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _describe(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, two hashes and size of its set, first choices and sketch (least hash of each of BINS ranges, one byte)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                tokens, at = token_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                size = np.diff(at)
                row = np.repeat(np.arange(hi - lo), size)
                limit = _limits(size)[row]
                chosen, owner = [], []
                for seed in _SEEDS:
                    value = mix(tokens ^ seed)
                    pick = value < limit
                    chosen.append(mix(value[pick] + seed))
                    owner.append(row[pick])
                chosen, owner = np.concatenate(chosen), np.concatenate(owner)
                order = np.argsort(owner, kind="stable")
                paths_at = np.append(0, np.cumsum(np.bincount(owner, minlength=hi - lo)))
                bins = (tokens >> U64(58)).astype(np.int64) + row * BINS
                first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1])[: len(bins)])
                sketch = np.zeros((hi - lo) * BINS, np.uint8)
                sketch[bins[first]] = (tokens[first] % U64(255)).astype(np.uint8) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(_sums(mix(tokens), at).view(np.int64)),
                        pa.array(_sums(mix(tokens ^ U64(0x5851F42D4C957F2D)), at).view(np.int64)), pa.array(size, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(paths_at, pa.int32()), pa.array(chosen[order].view(np.int64))),
                        pa.array([bytes(s) for s in sketch.reshape(-1, BINS)], pa.binary()),
                    ],
                    names=["doc_id", "text_key", "h1", "h2", "size", "paths", "sketch"],
                )

    return docs.mapInArrow(run, "doc_id long, text_key long, h1 long, h2 long, size int, paths array<long>, sketch binary")


def _alike(sketches: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Which pairs may be similar, by size and sketch: a pair of similarity 0.8 fails at six standard deviations only."""
    s = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, BINS)
    small = sizes < SKETCH_LEAST
    out = np.zeros((len(s), len(s)), bool)
    for i in range(len(s)):
        either = ((s[i] > 0) | (s > 0)).sum(1)
        same = ((s[i] == s) & (s > 0)).sum(1)
        out[i] = (2 * same >= either) | small[i] | small
    near = np.minimum(sizes[:, None], sizes) * NEAR[1] >= np.maximum(sizes[:, None], sizes) * NEAR[0]
    out &= near
    np.fill_diagonal(out, False)
    return out


def _screen(buckets: DataFrame) -> DataFrame:
    """Of every small bucket (path, members: array of sid, size, sketch): the ids that may be similar to another member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1).offsets.to_numpy()
            flat = batch.column(1).flatten()
            ids, size, sketch = (flat.field(c) for c in ("sid", "size", "sketch"))
            ids, size, at = ids.to_numpy(), size.to_numpy().astype(np.int64), at - at[0]
            paths, kept = [], []
            for k, path in enumerate(batch.column(0).to_pylist()):
                a, b = at[k], at[k + 1]
                left = ids[a:b][_alike(sketch.slice(a, b - a).to_pylist(), size[a:b]).any(1)]
                if len(left) > 1:
                    paths.append(path)
                    kept.append(np.sort(left))
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.int64()), pa.array(kept, pa.list_(pa.int64()))], names=["path", "ids"]
            )

    return buckets.mapInArrow(run, "path long, ids array<long>")


def _dense(samples: DataFrame) -> DataFrame:
    """path of the crowded buckets in whose sample (members) a fair share of the pairs is alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                alike = _alike([m["sketch"] for m in members], np.array([m["size"] for m in members]))
                if alike.sum() >= DENSE * len(members) * (len(members) - 1):
                    found.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["path"])

    return samples.mapInArrow(run, "path long")


def _choose_again(rows: DataFrame) -> DataFrame:
    """(parent, path, depth, sid) of the further choices of every set (sid, tokens, path) below a crowded path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            ids, paths = batch.column(0).to_numpy(), batch.column(2).to_numpy().view(U64)
            for k, tokens in enumerate(batch.column(1)):
                tokens = tokens.values.to_numpy().view(U64)
                limit = _limits(np.array([len(tokens)]))[0]
                parents = paths[k : k + 1]
                for depth in range(2, DEPTH + 1):
                    below = []
                    for parent in parents:
                        value = mix(tokens ^ mix(np.array([parent]))[0])
                        path = mix(value[value < limit] + parent)
                        below.append(path)
                        out.append((np.full(len(path), parent), path, np.full(len(path), depth), np.full(len(path), ids[k])))
                    parents = np.concatenate(below) if below else parents[:0]
            if out:
                parent, path, depth, ids_ = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parent.view(np.int64)), pa.array(path.view(np.int64)), pa.array(depth, pa.int32()), pa.array(ids_, pa.int64())],
                    names=["parent", "path", "depth", "sid"],
                )

    return rows.select("sid", "tokens", "path").mapInArrow(run, "parent long, path long, depth int, sid long")


def _tokens(docs: DataFrame) -> DataFrame:
    """sid and the whole set of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for lo, hi in slices(offsets):
                tokens, at = token_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_sums(mix(tokens), at).view(np.int64)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(tokens.view(np.int64)))],
                    names=["sid", "tokens"],
                )

    return docs.select("text").mapInArrow(run, "sid long, tokens array<long>")


def _common(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shingles that each two of the sets have in common."""
    n = len(at) - 1
    owner = np.repeat(np.arange(n), np.diff(at))
    _, back, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = count[back] > 1
    _, column = np.unique(back[shared], return_inverse=True)
    owner, out = owner[shared], np.zeros((n, n), np.float32)
    width = int(column.max()) + 1 if len(column) else 0
    for lo in range(0, width, 4096):
        part = (column >= lo) & (column < lo + 4096)
        holds = np.zeros((n, min(4096, width - lo)), np.float32)
        holds[owner[part], column[part] - lo] = 1
        out += holds @ holds.T
    return np.rint(out).astype(np.int64)


def _compare(rows: DataFrame) -> DataFrame:
    """sid, set_id, links, root_id and root of every set with a similar set, for each (path, low, high) bucket of the rows.

    links counts the rows of similar sets for pairs whose first common bucket is this one; (root_id, root) is the least
    (set_id, sid) that similar pairs of this bucket connect the set with.
    """

    def solve(t: pa.Table) -> pa.RecordBatch | None:
        path, low, high = (t[c][0].as_py() for c in ("path", "low", "high"))
        sids, copies, chunk = t["sid"].to_numpy(), t["copies"].to_numpy(), t["chunk"].to_numpy()
        tokens = t["tokens"].combine_chunks()
        at = tokens.offsets.to_numpy()
        inter = _common(tokens.values.to_numpy()[at[0] : at[-1]], at - at[0])
        size = np.diff(at)
        near = (NEAR[0] + NEAR[1]) * inter >= NEAR[0] * (size[:, None] + size)
        np.fill_diagonal(near, False)
        if low != high:
            near &= chunk[:, None] != chunk
        if not near.any():
            return None
        buckets = t["buckets"].combine_chunks()
        which, where = buckets.values.to_numpy(), buckets.offsets.to_numpy()
        before = (which < path) & (np.arange(len(which)) >= where[0]) & (np.arange(len(which)) < where[-1])
        owner = np.repeat(np.arange(len(sids)), np.diff(where))
        met = np.zeros_like(near)
        if before.any():
            _, column = np.unique(which[before], return_inverse=True)
            own = owner[before[where[0] : where[-1]]]
            earlier = np.zeros((len(sids), int(column.max()) + 1), np.float32)
            earlier[own, column] = 1
            met = earlier @ earlier.T > 0
        links = (near & ~met) @ copies
        names = t["set_id"].to_numpy()
        order = np.lexsort((sids, names))
        rank = np.empty(len(sids), np.int64)
        rank[order] = np.arange(len(sids))
        while True:  # least set reached over similar pairs
            least = np.minimum(rank, np.where(near, rank, len(sids)).min(1))
            if (least == rank).all():
                break
            rank = least
        keep = near.any(1)
        root = order[rank[keep]]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (sids[keep], names[keep], links[keep].astype(np.int64), names[root], sids[root])],
            names=["sid", "set_id", "links", "root_id", "root"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([*held, batch]).combine_chunks()
            del batch
            key = np.stack([t[c].to_numpy() for c in ("path", "low", "high")])
            cuts = np.append(0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if (out := solve(t.slice(a, b - a))) is not None:
                    yield out
            held = t.take(pa.array(np.arange(cuts[-1], len(t)))).combine_chunks().to_batches()  # the last bucket may go on; a copy, so that t goes
            del t
        if held and (out := solve(pa.Table.from_batches(held).combine_chunks())) is not None:
            yield out

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.select("path", "low", "high", "chunk", "sid", "set_id", "copies", "buckets", "tokens")
        .repartition(n, "path", "low", "high").sortWithinPartitions("path", "low", "high")
        .mapInArrow(run, "sid long, set_id long, links long, root_id long, root long")
    )


class _Steps:
    """Work tables of one run in the shared folder."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """The rows written and read back."""
        path = self.paths[name] = work_path(self.spark, name)
        df.write.option("compression", "zstd").parquet(path)
        self.spark._jvm.System.gc()  # lets Spark's cleaner take the shuffle files of finished jobs
        return self.spark.read.parquet(path)

    def drop_but(self, *names: str) -> None:
        """Delete the tables that the result does not read."""
        for name in self.paths.keys() - {*names}:
            remove_path(self.spark, self.paths.pop(name))


def _screened(met: DataFrame, sets: DataFrame) -> DataFrame:
    """path, sid of small buckets (path, sid) after the screen; buckets left with the same sets are one."""
    members = met.join(sets.select("sid", "size", "sketch"), "sid").groupBy("path").agg(
        F.collect_list(F.struct("sid", "size", "sketch")).alias("members")
    )
    return _screen(members).groupBy("ids").agg(F.min("path").alias("path")).select("path", F.explode("ids").alias("sid"))


def _further_buckets(again: DataFrame, sets: DataFrame, steps: _Steps) -> DataFrame:
    """path, sid, n of the buckets in which crowded ones end: small enough, or as deep as choices go."""
    sizes = steps.store(again.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1"), "further-sizes")
    above = sizes.select(F.col("path").alias("parent"), F.col("n").alias("above"))
    ends = (
        again.join(sizes, "path").join(above, "parent", "left")
        .filter((F.col("depth") == 2) | (F.col("above") > SMALL)).filter((F.col("n") <= SMALL) | (F.col("depth") == DEPTH))
    )
    few = _screened(ends.filter(F.col("n") <= SMALL).select("path", "sid"), sets)
    return few.withColumn("n", F.lit(1).cast("long")).unionByName(ends.filter(F.col("n") > SMALL).select("path", "sid", "n"))


def text_key(text: Column) -> Column:
    """What tells the texts of one id apart; a null text counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, copy_id and n_links of every row of `docs`, as `linked_rows` gives them."""
    return linked_rows(docs, id_col, text_col).drop("text_key", "first")


def linked_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, copy_id, n_links, text_key and first of every row of `docs`.

    Two rows are linked if the Jaccard similarity of their sets of five-word shingles is 0.8 or more (words as in
    `arrays.words`; a text of one to four words is one shingle). n_links counts the other rows a row is linked with, its
    copies included. class_id is the least doc_id that links lead to, over any number of them; copy_id the least doc_id
    of the rows with the same set. A text without words, or null, is linked with nothing and a class of its own.
    Repeated rows are copies; a null id counts as the least one. Different texts under one id, or without one, are linked
    by their sets alone; as classes are named by ids, two of them can then have one class_id. first marks the row of every
    class that has its least id (with all rows that repeat it; of several texts under that id the one with the least set
    and text_key). An empty table gives no rows; other columns are ignored.
    """
    null_id = -(1 << 63)
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(null_id)).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        text_key(F.col(text_col)).alias("text_key"),
    )
    steps = _Steps(docs.sparkSession)
    described = steps.store(_describe(texts), "shingle-sets")
    key = ["h1", "h2", "size"]
    counted = described.filter("size > 0").groupBy(*key).agg(F.min(F.struct("doc_id", "text_key")).alias("least"), F.count("*").alias("copies"))
    counted = counted.select(*key, F.col("least.doc_id").alias("set_id"), F.col("least.text_key").alias("text_key"), "copies")
    sets = steps.store(  # one row per distinct set, named by its first hash
        described.withColumnRenamed("doc_id", "set_id").join(counted, ["set_id", "text_key", *key])
        .withColumnRenamed("h1", "sid").dropDuplicates(["sid"]),
        "distinct-sets",
    )
    chosen = sets.select("sid", F.explode("paths").alias("path"))
    # sums are written before they are joined back, so that Spark may split the join where a path is hot
    sizes = steps.store(chosen.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1"), "bucket-sizes")
    met = steps.store(chosen.join(sizes, "path"), "buckets")

    small = steps.store(_screened(met.filter(F.col("n") <= SMALL).select("path", "sid"), sets), "small-buckets")
    crowded = met.filter(F.col("n") > SMALL)
    by_hash = Window.partitionBy("path").orderBy(F.xxhash64("sid"))
    sampled = (
        crowded.withColumn("k", F.row_number().over(by_hash)).filter(F.col("k") <= SAMPLE).join(sets.select("sid", "size", "sketch"), "sid")
        .groupBy("path").agg(F.collect_list(F.struct("sid", "size", "sketch")).alias("members"))
    )
    dense = steps.store(_dense(sampled), "dense-buckets")

    active = small.select("sid").unionByName(crowded.select("sid")).distinct()
    wanted = active.join(sets.select("sid", "set_id", "text_key", "copies"), "sid")
    first_texts = texts.join(wanted.select(F.col("set_id").alias("doc_id"), "text_key").distinct(), ["doc_id", "text_key"])
    tokens = steps.store(_tokens(first_texts).join(wanted.drop("text_key"), "sid").dropDuplicates(["sid"]), "tokens")

    again = steps.store(_choose_again(crowded.select("path", "sid").join(dense, "path", "left_anti").join(tokens.select("sid", "tokens"), "sid")), "further-choices")
    buckets = steps.store(
        small.withColumn("n", F.lit(1).cast("long"))  # one chunk
        .unionByName(crowded.join(dense, "path").select("path", "sid", "n")).unionByName(_further_buckets(again, sets, steps)), "final-buckets"
    )
    lists = buckets.groupBy("sid").agg(F.sort_array(F.collect_set("path")).alias("buckets"))
    parts = buckets.withColumn("k", F.ceil(F.col("n") / CHUNK).cast("int"))
    parts = parts.withColumn("chunk", F.pmod(F.xxhash64("sid", "path"), F.col("k")).cast("int"))
    placed = parts.select("path", "sid", "chunk", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")).select(
        "path", "sid", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")
    )
    links = steps.store(_compare(placed.join(tokens.join(lists, "sid"), "sid")), "links")

    steps.drop_but("shingle-sets", "distinct-sets", "links")

    per_set = links.groupBy("sid").agg(F.sum("links").alias("links"))
    node = lambda i, sid: F.struct(F.col(i).alias("id"), F.col(sid).alias("sid"))
    roots = components(links.select(node("set_id", "sid").alias("a"), node("root_id", "root").alias("b")))
    named = (
        sets.select(F.col("sid").alias("h1"), "h2", "size", "set_id", F.col("text_key").alias("set_key"), "copies")
        .join(per_set.withColumnRenamed("sid", "h1"), "h1", "left").join(roots.select(F.col("node.sid").alias("h1"), "root"), "h1", "left")
        .select(
            *key, "set_id", "set_key", F.coalesce("root.id", "set_id").alias("class_id"), F.isnull("root").alias("is_root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    id_of = lambda c: F.nullif(F.coalesce(F.col(c), F.col("doc_id")), F.lit(null_id)).alias(c)
    first = F.col("is_root") & (F.col("doc_id") == F.col("set_id")) & (F.col("text_key") == F.col("set_key"))
    return described.select("doc_id", "text_key", *key).join(named, key, "left").select(
        F.nullif("doc_id", F.lit(null_id)).alias("doc_id"), id_of("class_id"), id_of("set_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "text_key", F.coalesce(first, F.lit(True)).alias("first"),
    ).withColumnRenamed("set_id", "copy_id")
