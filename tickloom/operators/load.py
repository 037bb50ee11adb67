"""Incremental loading: high-water marks, upserts, late rows, gaps, deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.labels import is_trading
from tickloom.functions.times import instant, latest_closed_open
from tickloom.operators.latest import latest_by_key, newest_n
from tickloom.vocab import CANDLE_STEP_SECONDS, WARMUP_ROWS


def watermarks(df: DataFrame, keys: Sequence[str], ts: str, out: str = "watermark") -> DataFrame:
    """Greatest `ts` per key (with no keys: of the whole table)."""
    return df.groupBy(*keys).agg(F.max(ts).alias(out))


def incremental(
    new: DataFrame, loaded: DataFrame, keys: Sequence[str], ts: str, late_policy: str = "drop", marks: DataFrame | None = None
) -> DataFrame:
    """Rows of `new` still to be loaded.

    'drop' keeps rows strictly after the key's high-water mark, so late rows are lost.
    'recompute_month' also keeps every row of any month that received a late row.
    The marks are one row per key: Spark broadcasts them if they are small and otherwise
    shuffles, splitting a hot key through the adaptive skew join. `marks` (keys and `ts`, kept by
    `advance_marks`) spares the scan of `loaded`.
    """
    if keys:
        stored = watermarks(loaded, keys, ts, "__mark") if marks is None else marks.select(*keys, F.col(ts).alias("__mark"))
        joined = new.join(stored, list(keys), "left")
    else:
        joined = new.withColumn("__mark", loaded.select(F.max(ts)).scalar())
    fresh = F.col("__mark").isNull() | (F.col(ts) > F.col("__mark"))
    if late_policy == "drop":
        return joined.where(fresh).drop("__mark")
    if late_policy != "recompute_month":
        raise ValueError(f"unknown late_policy {late_policy!r}")
    month = F.date_format(ts, "yyyy-MM")
    behind = joined.where(~fresh).select(*keys, ts)
    touched = behind.select(F.date_format(ts, "yyyy-MM").alias("__month")).distinct()
    seen = loaded.select(*keys, ts, month.alias("__month")).join(touched, "__month", "left_semi").drop("__month")
    late = (
        behind.join(seen, [*keys, ts], "left_anti")
        .select(*keys, month.alias("__month")).distinct()
    )
    marked = joined.withColumn("__month", month).join(
        late.withColumn("__late", F.lit(True)), [*keys, "__month"], "left"
    )
    return marked.where(fresh | F.col("__late")).drop("__mark", "__month", "__late")


def advance_marks(marks: DataFrame, new: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Marks after a load: the greatest `ts` per key of the stored marks and the new rows."""
    return watermarks(marks.select(*keys, ts).unionByName(new.select(*keys, ts)), keys, ts, ts)


def load_candles(new: DataFrame, loaded: DataFrame) -> DataFrame:
    return incremental(new, loaded, ["symbol"], "open_time")


def load_ticker(new: DataFrame, loaded: DataFrame) -> DataFrame:
    return incremental(new, loaded, ["symbol"], "snapshot_time")


def load_order_book(new: DataFrame, loaded: DataFrame) -> DataFrame:
    """Book times are stored in whole seconds; truncating first keeps a re-sent row from loading again."""
    return incremental(new.withColumn("timestamp", F.date_trunc("second", "timestamp")), loaded, ["symbol"], "timestamp")


def load_news(new: DataFrame, loaded: DataFrame) -> DataFrame:
    """One mark for the whole table."""
    return incremental(new, loaded, [], "extracted_at")


def late_rows(new: DataFrame, loaded: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows at or behind the high-water mark: what the 'drop' policy loses."""
    marks = watermarks(loaded, keys, ts, "__mark")
    return new.join(marks, list(keys), "inner").where(F.col(ts) <= F.col("__mark")).drop("__mark")


def union_evolving(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns missing on one side become NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = (), newest_wins: bool = False) -> DataFrame:
    """Merge of two frames: per key the last row wins, new rows beat existing ones.

    With `newest_wins` the row with the greatest `order` wins, whichever frame it is in; new rows only break ties.
    """
    both = union_evolving(
        existing.withColumn("__batch", F.lit(0)), new.withColumn("__batch", F.lit(1))
    )
    rank = [*order, "__batch"] if newest_wins else ["__batch", *order]
    return latest_by_key(both, keys, rank).drop("__batch")


def insert_new(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Candidates whose key is not present yet."""
    return candidates.join(existing.select(key), key, "left_anti")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that survive a DELETE; a NULL condition does not delete."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def load_audit(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Row count, distinct keys and covered range of a load."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(key).alias("n_symbols"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )


#: log2 of the buckets of a distinct-count sketch; the standard error is some 1.6 %, two of three estimates are nearer.
SKETCH_BITS = 12


def audit_parts(df: DataFrame, key: str, ts: str, *groups: str) -> DataFrame:
    """Audit rows that merge: per group (a month, a load) the row count, the covered range and a sketch of distinct keys.

    A sketch has a fixed size, so tasks merge before the shuffle whatever the number of keys.
    """
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(key, SKETCH_BITS).alias("sketch"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )


def merged_audit(parts: DataFrame, *groups: str) -> DataFrame:
    """What `load_audit` says of all rows behind the parts, per group or of everything; n_symbols is an estimate."""
    return parts.groupBy(*groups).agg(
        F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_symbols"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
    )


def closed_only(df: DataFrame, ts: str, as_of: Column, step: int = CANDLE_STEP_SECONDS) -> DataFrame:
    """Drop the candle that is still open at `as_of`."""
    return df.where(F.col(ts) <= latest_closed_open(as_of, step))


def target_end(break_date: Column, status: Column, as_of: Column) -> Column:
    """Last instant to fetch: the break date of a delisted symbol, else the newest closed candle."""
    return F.when(is_trading(status) | break_date.isNull(), latest_closed_open(as_of)).otherwise(
        break_date.cast("timestamp")
    )


def gap_ranges(dim: DataFrame, loaded: DataFrame, ts: str, as_of: Column) -> DataFrame:
    """Per symbol the range still to fetch; a symbol without rows needs a bootstrap.

    `dim` carries symbol, status and break_date. Up-to-date symbols are left out.
    """
    marks = watermarks(loaded, ["symbol"], ts)
    out = dim.join(marks, "symbol", "left").withColumn(
        "fetch_to", target_end(F.col("break_date"), F.col("status"), as_of)
    )
    return out.select(
        "symbol",
        F.timestamp_seconds(F.unix_seconds(instant(F.col("watermark"))) + CANDLE_STEP_SECONDS).alias("fetch_from"),
        "fetch_to",
        F.col("watermark").isNull().alias("bootstrap"),
    ).where(F.col("bootstrap") | (F.col("fetch_from") <= F.col("fetch_to")))


def missing_candles(df: DataFrame, ts: str, step: int = CANDLE_STEP_SECONDS) -> DataFrame:
    """Grid points between a symbol's first and last candle that hold no row.

    The grid is generated day by day, so one long-lived symbol is spread over many tasks and
    its size follows the calendar, not the row count.
    """
    seconds = F.unix_seconds(instant(F.col(ts)))
    present = df.select("symbol", (seconds - F.pmod(seconds, F.lit(step))).alias("s")).distinct()
    span = present.groupBy("symbol").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    day = 86400
    days = span.select(
        "symbol", "lo", "hi",
        F.explode(F.sequence(F.col("lo") - F.pmod("lo", F.lit(day)), F.col("hi"), F.lit(day))).alias("d"),
    ).repartition("symbol", "d")
    grid = days.select("symbol", "lo", "hi", F.explode(
        F.sequence(F.col("d"), F.col("d") + F.lit(day - step), F.lit(step))
    ).alias("s")).where(F.col("s").between(F.col("lo"), F.col("hi")))
    gaps = grid.select("symbol", "s").join(present, ["symbol", "s"], "left_anti")
    return gaps.select("symbol", F.timestamp_seconds("s").alias("open_time"))


def with_warmup(
    history: DataFrame, new: DataFrame, keys: Sequence[str], ts: str, rows: int = WARMUP_ROWS
) -> DataFrame:
    """New rows preceded, per key, by the last `rows` rows of history; `is_context` tells them apart."""
    context = newest_n(history, keys, [ts], rows)
    return union_evolving(
        context.withColumn("is_context", F.lit(True)), new.withColumn("is_context", F.lit(False))
    )
