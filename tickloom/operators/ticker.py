"""24-hour ticker snapshots: transform, trends, tops, snapshot joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.numbers import finite_or, to_double
from tickloom.functions.times import bucket, since
from tickloom.operators.latest import at_global_latest, latest_by_key, latest_known, top_n
from tickloom.vocab import TICKER_COLUMNS


def spread_of_ask(bid: Column, ask: Column) -> Column:
    """(ask - bid) / ask in percent; 0 when either side is missing, not a number or ask is 0."""
    b, a = to_double(bid), to_double(ask)
    return F.coalesce(F.try_divide(a - b, a) * 100, F.lit(0.0))


def ticker_transform(df: DataFrame, as_of: Column) -> DataFrame:
    """Wire names to column names, one snapshot time per run, spread, missing columns as NULL."""
    named = df.select(
        "symbol", *[F.col(wire).alias(name) for wire, name in TICKER_COLUMNS.items() if wire in df.columns]
    )
    spread = F.lit(0.0)
    if {"bid_price", "ask_price"} <= set(named.columns):
        spread = spread_of_ask(F.col("bid_price"), F.col("ask_price"))
    full = named.withColumns({"snapshot_time": as_of, "spread_pct": spread})
    return full.select(
        *[
            F.col(c) if c in full.columns else F.lit(None).cast("string").alias(c)
            for c in schemas.columns(schemas.TICKER)
        ]
    )


def tracked(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows whose symbol is registered."""
    return df.join(dim.select("symbol"), "symbol", "left_semi")


def spread_daily(df: DataFrame, days: int = 30, as_of=None, month: str | None = None) -> DataFrame:
    """Average, greatest and least spread per symbol and day; `month` names a 'yyyy-MM' partition column to prune by."""
    return (
        since(df, "snapshot_time", days, as_of, month)
        .groupBy("symbol", F.to_date("snapshot_time").alias("day"))
        .agg(
            F.round(F.avg("spread_pct"), 6).alias("avg_spread_pct"),
            F.round(F.max("spread_pct"), 6).alias("max_spread_pct"),
            F.round(F.min("spread_pct"), 6).alias("min_spread_pct"),
        )
    )


def ticker_trend(df: DataFrame, size: int | str, days: int, as_of=None, month: str | None = None) -> DataFrame:
    """Averages of change, volume, spread and trade count per symbol and bucket; `month` as in `spread_daily`."""
    return (
        since(df, "snapshot_time", days, as_of, month)
        .groupBy("symbol", bucket(F.col("snapshot_time"), size).alias("ts"))
        .agg(
            F.avg("price_change_pct").alias("avg_price_change_pct"),
            F.avg("volume_24h").alias("avg_volume_24h"),
            F.avg("spread_pct").alias("avg_spread_pct"),
            F.avg("trade_count").alias("avg_trade_count"),
        )
    )


def latest_ticker(df: DataFrame, order=("snapshot_time",)) -> DataFrame:
    """Newest change, volume and spread per symbol; missing numbers read 0."""
    newest = latest_by_key(df, ["symbol"], order)
    return newest.select(
        "symbol", *[finite_or(F.col(c), 0).alias(c) for c in ("price_change_pct", "volume_24h", "spread_pct")]
    )


def with_billions(df: DataFrame, column: str, out: str) -> DataFrame:
    return df.withColumn(out, F.round(F.col(column) / 1_000_000_000, 2))


def top_by_latest(df: DataFrame, by: str, n: int = 10, ascending: bool = False, order=("snapshot_time",)):
    """Top (or bottom) n symbols by their newest snapshot."""
    return top_n(latest_by_key(df, ["symbol"], order), by, n, ["symbol"], ascending)


def top_at_global_latest(df, dim, by: str, n: int, ascending=False, where=None, newest=None) -> DataFrame:
    """Top n rows of the overall newest snapshot; symbols missing there do not appear."""
    rows = at_global_latest(df, "snapshot_time", newest)
    if where is not None:
        rows = rows.where(where)
    named = rows.join(dim.select("symbol", "base_asset"), "symbol")
    return top_n(named, by, n, ["symbol"], ascending)


def market_snapshot(dim: DataFrame, klines: DataFrame, ticker: DataFrame, order=("snapshot_time",)) -> DataFrame:
    """Every symbol with its newest close and 24-hour change, NULL where it has none.

    With the delivery order at the end of `order` a raw ticker needs no dedup first.
    """
    last_candle = klines.groupBy("symbol").agg(
        F.max("open_time").alias("latest_kline_time"), F.max_by("close", "open_time").alias("latest_close")
    )
    last_ticker = latest_by_key(ticker, ["symbol"], order).select(
        "symbol", F.col("price_change_pct").alias("change_24h_pct")
    )
    return (
        dim.select("symbol", "base_asset")
        .join(last_candle, "symbol", "left")
        .join(last_ticker, "symbol", "left")
    )


def latest_rsi(klines: DataFrame) -> DataFrame:
    """Newest time and newest known RSI per symbol."""
    return klines.groupBy("symbol").agg(
        F.max("open_time").alias("latest_time"), latest_known("rsi_14", "open_time").alias("latest_rsi")
    )
