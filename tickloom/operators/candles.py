"""Candle re-bucketing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import adaptive_seconds, between, bucket, since
from tickloom.operators.latest import newest_n, oldest_n


def candles(
    df: DataFrame,
    size: int | str,
    lookback_days: int | None = None,
    limit: int | None = None,
    keep: str = "oldest",
    as_of=None,
    keys: Sequence[str] = ("symbol",),
    sums: Sequence[str] = ("volume",),
    month: str | None = None,
) -> DataFrame:
    """Open/high/low/close and summed volumes per key and bucket.

    First and last prices are min_by/max_by over fixed-width values, so the map side already
    reduces to one row per bucket. `limit` keeps the oldest buckets of the lookback by default,
    which may leave out the newest one; keep='latest' keeps the newest instead. `month` names a
    'yyyy-MM' partition column, so that only the months of the lookback are read.
    """
    rows = df if lookback_days is None else since(df, "open_time", lookback_days, as_of, month)
    out = rows.groupBy(*keys, bucket(F.col("open_time"), size).alias("ts")).agg(
        F.min_by("open", "open_time").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "open_time").alias("close"),
        *[F.sum(c).alias(c) for c in sums],
    )
    if limit is None:
        return out
    pick = {"oldest": oldest_n, "latest": newest_n}[keep]
    return pick(out, keys, ["ts"], limit)


def candles_between(df: DataFrame, start, end, keys: Sequence[str] = ("symbol",), month: str | None = None) -> DataFrame:
    """Chart candles for [start, end] with a width chosen from the range; volume is quote volume."""
    rows = between(df, "open_time", start, end, month)
    width = adaptive_seconds((end - start).total_seconds())
    return candles(rows, width, keys=keys, sums=("quote_volume",)).withColumnRenamed("quote_volume", "volume")
