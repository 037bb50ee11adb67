"""Streaming candles and delivery dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import instant


def stream_dedup(src: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop repeated deliveries of a key; state is kept for `delay` of event time."""
    timed = src.withColumn(ts, instant(F.col(ts)))  # event time must be a TIMESTAMP
    return timed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_candles(src: DataFrame, size: str, delay: str, ts: str = "open_time") -> DataFrame:
    """Candles per symbol and tumbling window, emitted once the watermark passes their end."""
    return (
        src.withColumn(ts, instant(F.col(ts)))
        .withWatermark(ts, delay)
        .groupBy("symbol", F.window(ts, size).alias("w"))
        .agg(
            F.min_by("open", ts).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", ts).alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select("symbol", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume")
    )
