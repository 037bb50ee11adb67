"""RSI heatmap: newest and previous RSI per symbol with zone, volume and change."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.labels import in_zone, rsi_zone
from tickloom.functions.times import from_month, instant, newest
from tickloom.operators.candles import candles
from tickloom.operators.indicators import rsi_sma
from tickloom.operators.latest import latest_values

# Selectable bar widths in seconds and the lookback in bars.
BAR_SECONDS = {"1h": 3600, "4h": 14400}
LOOKBACK_BARS = 80


def rsi_heatmap(
    klines: DataFrame, ticker: DataFrame, dim: DataFrame, tf: str = "4h", zone: str = "All", month: str | None = None
) -> DataFrame:
    """One row per trading symbol with two known RSI values and volume.

    The lookback bounds the window to about 80 bars per symbol; the previous RSI comes from a
    lag over the same window instead of a self join. `month` names a 'yyyy-MM' partition column.
    """
    width = BAR_SECONDS.get(tf, 86400)
    last = newest(klines, "open_time")
    low = last - F.make_dt_interval(secs=F.lit(width * LOOKBACK_BARS))
    recent = from_month(klines.where(F.col("open_time") >= low), low, None, month)
    bars = rsi_sma(candles(recent, width, sums=()))
    order = Window.partitionBy("symbol").orderBy("ts")
    pairs = bars.withColumns(
        {
            "prev": F.lag("rsi").over(order),
            "rn": F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("ts"))),
        }
    ).where((F.col("rn") == 1) & F.col("rsi").isNotNull() & F.col("prev").isNotNull())
    volume = latest_values(ticker, ["symbol"], "snapshot_time", ["quote_volume_24h", "price_change_pct"])
    active = dim.where(F.col("status") == "TRADING").select("symbol", "base_asset")  # an unknown status is not shown
    joined = pairs.join(active, "symbol").join(volume.where(F.col("quote_volume_24h") > 0), "symbol")
    return (
        joined.select(
            "symbol",
            "base_asset",
            F.round("rsi", 2).alias("rsi"),
            F.round("prev", 2).alias("prev_rsi"),
            F.round(F.col("rsi") - F.col("prev"), 2).alias("rsi_delta"),
            rsi_zone(F.col("rsi")).alias("zone"),
            "quote_volume_24h",
            "price_change_pct",
            F.col("close").alias("latest_close"),
            F.date_format(instant(F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("latest_time"),
        )
        .where(in_zone(F.col("zone"), zone))
        .orderBy(F.desc("quote_volume_24h"))
    )
