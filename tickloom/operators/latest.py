"""Newest-row, first-row and top-n selections.

Every `row_number() <= n` below is planned with a per-partition limit ahead of the shuffle
(WindowGroupLimit), so at most n rows per key and map task travel, however hot the key is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = str | Column


def _desc(order: Sequence[Order]) -> list[Column]:
    return [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]


def _asc(order: Sequence[Order]) -> list[Column]:
    return [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]


def _ranked(df: DataFrame, keys: Sequence[str], order: list[Column], n: int, rank: str | None):
    name = rank or "__rank"
    spec = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(spec)).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def newest_n(df, keys, order, n, rank: str | None = None) -> DataFrame:
    """The `n` newest rows per key."""
    return _ranked(df, keys, _desc(order), n, rank)


def oldest_n(df, keys, order, n, rank: str | None = None) -> DataFrame:
    """The `n` oldest rows per key."""
    return _ranked(df, keys, _asc(order), n, rank)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """Last inserted row per key, i.e. what a replacing table shows when read as final."""
    return newest_n(df, keys, order, 1)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """First row per key (keep-first dedup)."""
    return oldest_n(df, keys, order, 1)


def latest_values(df: DataFrame, keys: Sequence[str], by: str, values: Sequence[str]) -> DataFrame:
    """Value of each column at the greatest `by`; for fixed-width values this is a hash aggregate."""
    return df.groupBy(*keys).agg(*[F.max_by(v, by).alias(v) for v in values])


def latest_known(value: str, by: str) -> Column:
    """Aggregate: newest non-NULL value."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(by)))


def top_n(df: DataFrame, by: str, n: int, tie: Sequence[str], ascending: bool = False) -> DataFrame:
    """The `n` greatest (or least) rows; `tie` makes the cut deterministic."""
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(first, *tie).limit(n)


def at_global_latest(df: DataFrame, ts: str, newest: Column | None = None) -> DataFrame:
    """Rows that carry the overall newest `ts` (a scalar subquery, no join).

    Pass `newest` from a cheaper frame where one is known, e.g. the table before dedup.
    """
    return df.where(F.col(ts) == (df.select(F.max(ts)).scalar() if newest is None else newest))


def at_latest(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """All rows at each key's newest `ts`.

    The newest times are reduced on the map side; everything older is dropped before any
    further work on the rows.
    """
    newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return df.join(newest, [*keys, ts])
