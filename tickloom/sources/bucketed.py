"""Tables bucketed and sorted by key: newest rows and joins of such tables need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators.latest import latest_by_key


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int = 64, mode: str = "overwrite") -> DataFrame:
    """Store `df` at `path` as table `name`, one file per bucket of `keys`, sorted by keys and `order`; the table.

    mode="append" adds files to the same buckets. Choose the number of buckets so that one fits a task: all rows of a key share a
    bucket, so a table whose newest rows are wanted per symbol is bucketed by the full key (symbol and time).
    """
    rows = df.repartition(buckets, *keys)
    rows.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys, *order).saveAsTable(name)
    return df.sparkSession.table(name)


def latest_bucketed(spark: SparkSession, name: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key of a bucketed table; rows of a key lie in one bucket, so each task finishes its own."""
    return latest_by_key(spark.table(name), keys, order)
