"""Roll-up pyramid of candles: stored partial states per minute, hour and day, and charts from the widest that fits.

A partial state holds what merging needs: first and last price with their times, extremes, sums and a count. Minutes are
made from rows, hours from minutes, days from hours. A load adds the states of its own rows, late ones too, and reading
merges states of one bucket, so nothing stored is rewritten. Loads are named: one that is repeated replaces itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import bucket
from tickloom.operators.load import union_evolving

#: Stored widths in seconds, narrowest first.
LEVELS = (60, 3600, 86400)


def partial_states(rows: DataFrame, seconds: int, sums: Sequence[str] = ("volume",), ts: str = "open_time") -> DataFrame:
    """States per (symbol, bucket) of candle or tick rows."""
    return rows.groupBy("symbol", bucket(F.col(ts), seconds).alias("ts")).agg(
        F.min(ts).alias("first_time"), F.min_by("open", ts).alias("open"), F.max(ts).alias("last_time"), F.max_by("close", ts).alias("close"),
        F.max("high").alias("high"), F.min("low").alias("low"), *[F.sum(c).alias(c) for c in sums], F.count(F.lit(1)).alias("n"),
    )


def merge_states(states: DataFrame, seconds: int, sums: Sequence[str] = ("volume",)) -> DataFrame:
    """States of wider buckets, or of the same ones from several loads; all values have fixed width, so tasks merge before the shuffle."""
    return states.groupBy("symbol", bucket(F.col("ts"), seconds).alias("ts")).agg(
        F.min("first_time").alias("first_time"), F.min_by("open", "first_time").alias("open"), F.max("last_time").alias("last_time"),
        F.max_by("close", "last_time").alias("close"), F.max("high").alias("high"), F.min("low").alias("low"),
        *[F.sum(c).alias(c) for c in (*sums, "n")],
    )


class Pyramid:
    """Partial states at `path`, in folders by level, month and load."""

    def __init__(self, spark: SparkSession, path: str, sums: Sequence[str] = ("volume",), levels: Sequence[int] = LEVELS):
        self.spark, self.path, self.sums, self.levels = spark, path.rstrip("/"), tuple(sums), tuple(sorted(levels))

    def add(self, rows: DataFrame, load: str) -> None:
        """Add the rows of one load; the same load again replaces what it added, so a repeated one counts once."""
        below = partial_states(rows, self.levels[0], self.sums)
        for k, level in enumerate(self.levels):
            if k:
                below = merge_states(self._read(self.levels[k - 1]).where(F.col("load") == load), level, self.sums)
            named = below.withColumns({"load": F.lit(load), "month": F.date_format("ts", "yyyy-MM")})
            named.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("month").parquet(f"{self.path}/level={level}/load={load}")

    def _read(self, level: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/level={level}").withColumn("month", F.col("month").cast("string"))

    def candles(self, size: int, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
        """Candles of `size` seconds for rows in [start, end]; without bounds of everything.

        Buckets that lie inside the range are read from the widest level that `size` is a multiple of, what is left at both ends
        from narrower ones. Only months of the range are read. `size` is a multiple of the narrowest level.
        """
        fitting = [level for level in self.levels if size % level == 0]
        if not fitting:
            raise ValueError(f"{size} s is no multiple of {self.levels[0]} s")
        parts, covered = [], F.lit(False)
        for level in reversed(fitting):
            inside = self._inside(level, start, end)
            part = self._read(level).where(inside & ~covered)
            if start is not None:
                part = part.where(F.col("month") >= f"{start:%Y-%m}")
            if end is not None:
                part = part.where(F.col("month") <= f"{end:%Y-%m}")
            parts.append(part)
            if start is None and end is None:
                break
            # a narrower bucket is covered if the wider one around it lies inside
            covered = covered | self._inside(level, start, end, bucket(F.col("ts"), level))
        states = union_evolving(*parts)
        out = merge_states(states, size, self.sums)
        return out.select("symbol", "ts", "open", "high", "low", "close", *self.sums)

    def _inside(self, level: int, start: dt.datetime | None, end: dt.datetime | None, ts: Column | None = None) -> Column:
        """Whether a whole bucket lies inside the range; rows stand on the grid of the narrowest level."""
        ts, out = F.col("ts") if ts is None else ts, F.lit(True)
        if start is not None:
            out = out & (ts >= F.lit(start))
        if end is not None:
            out = out & (ts <= F.lit(end - dt.timedelta(seconds=level - self.levels[0])))
        return out
