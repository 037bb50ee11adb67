"""Momentum indicators on candle series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numbers import positive_part
from tickloom.functions.times import bucket_seconds
from tickloom.operators.candles import candles
from tickloom.operators.ewm import Mean, carry_of, ewm
from tickloom.operators.load import with_warmup
from tickloom.vocab import CANDLE_STEP_SECONDS, WARMUP_ROWS

GAIN, LOSS = Mean("close", 14, "avg_gain", "rise"), Mean("close", 14, "avg_loss", "fall")
FAST, SLOW = Mean("close", 12, "ema_fast"), Mean("close", 26, "ema_slow")


def _strength(gain: Column, loss: Column) -> Column:
    return 100 - 100 / (1 + F.try_divide(gain, loss))


def rsi_from_means(gain: Column, loss: Column) -> Column:
    """RSI of exponential means: 0 without history or movement, 100 without losses."""
    return (
        F.when(gain.isNull() | loss.isNull() | ((gain == 0) & (loss == 0)), 0.0)
        .when(loss == 0, 100.0)
        .otherwise(_strength(gain, loss))
    )


def rsi_ewm(df, key="symbol", ts="open_time", step=CANDLE_STEP_SECONDS, n=14, carry=None) -> DataFrame:
    """Add rsi_14 from exponential means of gains and losses."""
    means = [Mean("close", n, "avg_gain", "rise"), Mean("close", n, "avg_loss", "fall")]
    out = ewm(df, key, ts, step, means, carry)
    return out.withColumn("rsi_14", rsi_from_means(F.col("avg_gain"), F.col("avg_loss"))).drop(
        "avg_gain", "avg_loss"
    )


def macd(df, key="symbol", ts="open_time", step=CANDLE_STEP_SECONDS, fast=12, slow=26, signal=9) -> DataFrame:
    """Add the MACD line, its signal line and their difference."""
    means = [Mean("close", fast, "ema_fast"), Mean("close", slow, "ema_slow")]
    line = ewm(df, key, ts, step, means).withColumn("macd", F.col("ema_fast") - F.col("ema_slow"))
    out = ewm(line.drop("ema_fast", "ema_slow"), key, ts, step, [Mean("macd", signal, "macd_signal")])
    return out.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))


def momentum(
    df, key="symbol", ts="open_time", step=CANDLE_STEP_SECONDS, carry=None, keep_means=False
) -> DataFrame:
    """Add rsi_14 and macd in one scan (the two columns a stored candle carries)."""
    out = ewm(df, key, ts, step, [GAIN, LOSS, FAST, SLOW], carry)
    out = out.withColumns(
        {
            "rsi_14": rsi_from_means(F.col("avg_gain"), F.col("avg_loss")),
            "macd": F.col("ema_fast") - F.col("ema_slow"),
        }
    )
    return out if keep_means else out.drop("avg_gain", "avg_loss", "ema_fast", "ema_slow")


def momentum_after_warmup(history: DataFrame, new: DataFrame, key="symbol", ts="open_time", rows=WARMUP_ROWS) -> DataFrame:
    """rsi_14 and macd of new rows, restarted from the last `rows` stored rows of each symbol.

    The bounded form of an incremental run: the means are cut off after `rows` rows, where
    `momentum` with a carry is exact.
    """
    run = momentum(with_warmup(history, new, [key], ts, rows), key, ts)
    return run.where(~F.col("is_context")).drop("is_context")


def momentum_state(df: DataFrame, key="symbol", ts="open_time") -> DataFrame:
    """Carry rows for the next incremental `momentum` run (input made with keep_means=True)."""
    return carry_of(df, key, ts, ["close"], [GAIN, LOSS, FAST, SLOW])


def candle_indicators(df: DataFrame, size: int | str, **kw) -> DataFrame:
    """Re-bucket, then RSI and MACD of the buckets (RSI-14 of daily candles is a 14-day RSI).

    Lazy: nothing runs while the plan is built. The raw table is read twice, the second time only the
    columns that closes need.
    """
    return momentum(candles(df, size, **kw), ts="ts", step=bucket_seconds(size))


def rsi_sma(df: DataFrame, keys: Sequence[str] = ("symbol",), ts: str = "ts", n: int = 14) -> DataFrame:
    """Add rsi from plain averages of the last n gains and losses; NULL for the first n rows.

    Meant for re-bucketed candles: rows per key are bounded by the calendar.
    """
    order = Window.partitionBy(*keys).orderBy(ts)
    frame = order.rowsBetween(-(n - 1), 0)
    delta = F.col("close") - F.lag("close").over(order)
    gain = F.avg(F.coalesce(positive_part(F.col("__delta")), F.lit(0.0))).over(frame)
    loss = F.avg(F.coalesce(positive_part(-F.col("__delta")), F.lit(0.0))).over(frame)
    out = df.withColumn("__delta", delta).withColumns(
        {"__n": F.row_number().over(order), "__gain": gain, "__loss": loss}
    )
    rsi = (
        F.when(F.col("__n") < n + 1, F.lit(None).cast("double"))
        .when((F.col("__gain") == 0) & (F.col("__loss") == 0), 50.0)
        .when(F.col("__loss") == 0, 100.0)
        .otherwise(_strength(F.col("__gain"), F.col("__loss")))
    )
    return out.withColumn("rsi", rsi).drop("__delta", "__n", "__gain", "__loss")
