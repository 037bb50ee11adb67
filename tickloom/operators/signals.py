"""Readable signals from candles with indicators, for all symbols at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numbers import finite_or, fixed
from tickloom.operators.latest import newest_n


SIGNALS = ("rsi", "macd", "volume", "structure")


def with_signals(df: DataFrame, keys: Sequence[str] = ("symbol",), ts: str = "ts") -> DataFrame:
    """Add `signal_rsi`, `signal_macd`, `signal_volume`, `signal_structure` and the candle count `n`.

    Every candle gets the signals as of itself, compared with the mean volume of the whole set.
    Input is a bounded candle set (a preset's limit per symbol).
    """
    order = Window.partitionBy(*keys).orderBy(ts)
    last5 = order.rowsBetween(-3, 0)
    whole = Window.partitionBy(*keys)
    rsi, macd = finite_or(F.col("rsi_14"), 50), finite_or(F.col("macd"), 0)
    steps = df.withColumns(
        {
            "r": rsi,
            "r0": F.lag(rsi).over(order),
            "m": macd,
            "m0": F.lag(macd).over(order),
            "up": F.col("high") - F.lag("high").over(order),
            "down": F.col("low") - F.lag("low").over(order),
            "v_avg": F.avg("volume").over(whole),
            "n": F.count(F.lit(1)).over(whole),
        }
    ).withColumns(
        # five bars hold four steps; the first bar has none and min/max skip its NULL
        {"rise": F.min("up").over(last5), "sink": F.max("down").over(last5)}
    )
    r, r0, m, m0 = (F.col(c) for c in ("r", "r0", "m", "m0"))

    def text(level: str, value, digits: int, direction) -> Column:
        return F.concat(F.lit(f"{level} ("), fixed(value, digits), F.lit(", "), direction, F.lit(")"))

    rising = F.when(r > r0, "rising").otherwise("falling")
    sinking = F.when(r < r0, "falling").otherwise("rising")
    ratio = F.try_divide(finite_or(F.col("volume"), 0), F.col("v_avg"))
    texts = {
        "rsi": F.when(r > 70, text("OVERBOUGHT", r, 1, rising))
        .when(r < 30, text("OVERSOLD", r, 1, sinking))
        .otherwise(text("NEUTRAL", r, 1, rising)),
        "macd": F.when((m > 0) & (m > m0), text("BULLISH", m, 2, F.lit("rising")))
        .when(m > 0, text("BULLISH", m, 2, F.lit("falling")))
        .when((m < 0) & (m < m0), text("BEARISH", m, 2, F.lit("falling")))
        .otherwise(text("BEARISH", m, 2, F.lit("rising"))),
        "volume": F.when(
            F.col("v_avg") > 0,
            F.concat(
                F.when(ratio > 1, "ABOVE").otherwise("BELOW"), F.lit(" average ("), fixed(ratio, 1), F.lit("x)")
            ),
        ).otherwise("NO DATA"),
        "structure": F.when(F.col("rise") >= 0, "HIGHER HIGHS (bullish structure)")
        .when(F.col("sink") <= 0, "LOWER LOWS (bearish structure)")
        .otherwise("MIXED (no clear trend structure)"),
    }
    return steps.select(*df.columns, "n", *[v.alias(f"signal_{k}") for k, v in texts.items()])


def signals(df: DataFrame, keys: Sequence[str] = ("symbol",), ts: str = "ts") -> DataFrame:
    """Signals of the newest candle per key; a key with fewer than two candles has none."""
    newest = newest_n(with_signals(df, keys, ts).where(F.col("n") >= 2), keys, [ts], 1)
    return newest.select(*keys, ts, *[F.col(f"signal_{s}").alias(s) for s in SIGNALS])


def signal_lines(column: Callable[[str], Column]) -> Column:
    """Signals as one text block; `column` gives the text of a signal."""
    lines = [F.concat(F.lit(f"{name.upper()}: "), column(name)) for name in SIGNALS]
    return F.concat_ws("\n", F.lit("--- Signals ---"), *lines)


def signal_block(df: DataFrame) -> DataFrame:
    """Output of `signals` as one text block per symbol."""
    return df.select("symbol", signal_lines(F.col).alias("signals"))
