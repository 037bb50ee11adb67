"""Sharding by k-d tree partitioning with distributed weighted medians, DataFrame functions only.

All rows of one text form a group and stay together. Groups are points in a space of metadata dimensions; a node that
stands for k shards is split along its widest dimension at the point where k // 2 of k parts of its bytes lie below, until
every leaf is one shard. The split point comes from histograms of at most BINS bins a node, narrowed down around the
median until what remains undecided is negligible, so no task and not the driver sees more than the bins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import cut_lineage

#: Bins of a histogram round, and the share of a shard's bytes that a split may miss its target by.
BINS = 512
TOLERANCE = 1e-4
#: Independent stretches of slots in a shard, numbered by separate tasks.
LANES = 64
#: Bits of a dimension's value in a split key; the text's hash fills the other 32 and orders equal values.
VALUE_BITS = 30

DIMENSIONS = ("log_size", "lang", "source", "first_id")


def document_metadata(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, text_hash, lang and source of every row; a missing metadata column counts as null."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = [F.col(c).cast("string").alias(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source")]
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"), *kept,
    )


def _groups(meta: DataFrame) -> DataFrame:
    """One row per text: its bytes and its place in every dimension, scaled to 0 .. 2**VALUE_BITS - 1."""
    unit = float(1 << VALUE_BITS) - 1
    ends = meta.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    low, width = float(ends["a"] or 0), max(1.0, float(ends["b"] or 0) - float(ends["a"] or 0))
    category = lambda c: F.pmod(F.xxhash64(F.coalesce(F.min(c), F.lit(""))), F.lit(1 << VALUE_BITS))
    return meta.groupBy("text_hash", "text_crc32", "size").agg(
        F.sum("size").alias("weight"),
        F.least(F.log2(F.col("size").cast("double")) / 40 * unit, F.lit(unit)).cast("long").alias("log_size"),
        category("lang").alias("lang"), category("source").alias("source"),
        ((F.coalesce(F.min("doc_id").cast("double"), F.lit(low)) - low) / width * unit).cast("long").alias("first_id"),
    )


def _key() -> Column:
    """Split key of a group in the dimension that is listed for its node."""
    value = reduce(lambda c, k: c.when(F.col("dimension") == k, F.col(DIMENSIONS[k])), range(len(DIMENSIONS)), F.when(F.lit(False), F.lit(0)))
    return F.shiftleft(value.cast("long"), 32) + F.pmod(F.col("text_hash"), F.lit(1 << 32))


def _nodes(points: DataFrame, schema: str, rows: list[tuple]) -> DataFrame:
    """The points of the listed nodes with what is listed for their node; the list has a row per open node."""
    values = ", ".join(f"({', '.join(map(str, r))})" for r in rows)
    names = [c.split()[0] for c in schema.split(", ")]
    casts = ", ".join(f"cast({n} as {c.split()[1]}) {n}" for n, c in zip(names, schema.split(", "), strict=True))
    listed = points.sparkSession.sql(f"SELECT cast(node as int) node, {casts} FROM VALUES {values} AS t(node, {', '.join(names)})")
    return points.join(F.broadcast(listed), "node")


def _split_points(points: DataFrame, wanted: dict[int, tuple[int, float, float]]) -> dict[int, int]:
    """Of every node: the key below which its wanted bytes lie, within the tolerance. wanted: dimension, bytes below, tolerance."""
    span = dict.fromkeys(wanted, (0, 1 << (VALUE_BITS + 32)))
    rest = {n: need for n, (_, need, _) in wanted.items()}
    found: dict[int, int] = {}
    while len(found) < len(wanted):
        open_ = [n for n in wanted if n not in found]
        bounds = [(n, wanted[n][0], *span[n], -(-(span[n][1] - span[n][0]) // BINS)) for n in open_]
        inside = _nodes(points, "dimension int, low long, high long, step long", bounds).select("node", "weight", "low", "high", "step", _key().alias("key"))
        bins = (
            inside.filter((F.col("key") >= F.col("low")) & (F.col("key") < F.col("high")))
            .groupBy("node", F.expr("(key - low) div step").alias("bin"))
            .agg(F.sum("weight").alias("weight"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        )
        for n in open_:
            below, cut = 0, None
            for b in sorted((b for b in bins if b["node"] == n), key=lambda b: b["low"]):
                if below + b["weight"] >= rest[n]:
                    cut = b
                    break
                below += b["weight"]
            if cut is None:
                found[n] = span[n][1]
                continue
            under, over = rest[n] - below, below + cut["weight"] - rest[n]
            if min(under, over) <= wanted[n][2] or cut["low"] == cut["high"]:
                found[n] = cut["low"] if under <= over else cut["high"] + 1
            else:
                span[n], rest[n] = (cut["low"], cut["high"] + 1), rest[n] - below
    return found


def kd_tree(groups: DataFrame, shards: int) -> tuple[DataFrame, list[dict]]:
    """The groups with their shard, and the tree's splits (node, dimension, key, nodes below and above).

    A level of the tree is a small table of splits that is joined to the groups, so a group's node is a chain of joins
    with tables of at most `shards` rows.
    """
    points = groups.withColumn("node", (F.col("weight") < 0).cast("int"))  # 0, but no constant: the first split is a join too
    parts, splits, fresh = {0: (0, shards)}, [], 1
    while any(k > 1 for _, k in parts.values()):
        open_ = [n for n, (_, k) in parts.items() if k > 1]
        seen = points.filter(F.col("node").isin(open_)).groupBy("node").agg(
            F.sum("weight").alias("weight"), *(F.struct(F.min(d).alias("a"), F.max(d).alias("b")).alias(d) for d in DIMENSIONS)
        ).collect()
        if not seen:  # no rows are left in any node that could be split
            break
        wanted = {}
        for r in seen:
            k = parts[r["node"]][1]
            widest = max(range(len(DIMENSIONS)), key=lambda d: r[DIMENSIONS[d]]["b"] - r[DIMENSIONS[d]]["a"])
            wanted[r["node"]] = (widest, r["weight"] * (k // 2) / k, TOLERANCE * r["weight"] / k)
        at = _split_points(points, wanted)
        moves, after = [], {}
        for n, (first, k) in parts.items():
            if n not in wanted:
                after[n] = (first, 1)
                moves.append((n, 0, 0, n, n))
                continue
            low, high, fresh = fresh, fresh + 1, fresh + 2
            after[low], after[high] = (first, k // 2), (first + k // 2, k - k // 2)
            moves.append((n, wanted[n][0], at[n], low, high))
            splits.append({"node": n, "dimension": DIMENSIONS[wanted[n][0]], "key": at[n], "below": low, "above": high})
        parts = after
        moved = _nodes(points, "dimension int, cut long, lower int, upper int", moves)
        points = moved.select(*groups.columns, F.when(_key() < F.col("cut"), F.col("lower")).otherwise(F.col("upper")).alias("node"))
    leaves = [(n, first) for n, (first, _) in parts.items()]
    return _nodes(points, "shard int", leaves), splits


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of `docs`.

    Law `bytes`: the shards' sizes are near equal, rows with equal texts are in one shard. size is the text's UTF-8
    bytes plus 8; a null text counts as the empty one, null metadata as an empty string, a null id as the smallest.
    slot runs from 0 without gaps in every shard; repeated rows have slots of their own. An empty table gives no
    rows; other columns are ignored. Where one text makes up more than a shard's share, its shard is larger.
    grown_shard is null under this law.

    The metadata (some 50 bytes a row) are checkpointed once; texts are read once and never shuffled.
    """
    meta = cut_lineage(document_metadata(docs, id_col, text_col))
    groups = cut_lineage(_groups(meta))
    placed, _ = kd_tree(groups, shards)
    group = ["text_hash", "text_crc32", "size"]
    rows = meta.select("doc_id", *group).join(placed.select(*group, "shard"), group)
    rows = rows.withColumn("lane", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(LANES))).repartition("shard", "lane")
    before = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "lane").agg(F.count("*").alias("rows"))
        .select("shard", "lane", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    )
    order = Window.partitionBy("shard", "lane").orderBy("doc_id", "text_hash")
    return (
        rows.withColumn("place", F.row_number().over(order) - 1).join(starts, ["shard", "lane"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
