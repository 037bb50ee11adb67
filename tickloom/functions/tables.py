"""SQL table functions over the reports, callable from plain SQL text with named arguments."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.indicators import candle_indicators
from tickloom.operators.reports import for_every_symbol, report_book, report_candles, report_news, ticker_report
from tickloom.presets import TIMEFRAMES, Timeframe, timeframe
from tickloom.vocab import NO_NEWS

#: Preset that stands in for an unknown timeframe.
MEDIUM = next(k for k, p in TIMEFRAMES.items() if p is timeframe(""))


def _view(name: str, frames: dict[str, DataFrame]) -> None:
    """The reports of all presets as one view; a literal timeframe leaves one branch, a literal symbol reaches its scan."""
    branches = [df.select(F.lit(k).alias("timeframe"), "symbol", "report") for k, df in frames.items()]
    reduce(DataFrame.unionAll, branches).createOrReplaceTempView(f"{name}_reports")


def _preset(names: dict[str, DataFrame]) -> str:
    known = ", ".join(f"'{k}'" for k in names)
    return f"CASE WHEN preset IN ({known}) THEN preset ELSE '{MEDIUM}' END"


def _function(spark: SparkSession, name: str, frames: dict[str, DataFrame]) -> None:
    """Table function `name(symbol, timeframe)` -> report of a symbol that has one."""
    _view(name, frames)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted STRING, preset STRING DEFAULT '{MEDIUM}')
        RETURNS TABLE (symbol STRING, report STRING)
        RETURN SELECT symbol, report FROM {name}_reports WHERE symbol = wanted AND timeframe = {_preset(frames)}""")


def _answering(spark: SparkSession, name: str, dim: DataFrame, reports: Callable[[Timeframe, DataFrame], DataFrame]) -> None:
    """The same, with one row for any symbol: one that `dim` does not list gets the report of a symbol without rows.

    That report is made along with the others, for a NULL symbol.
    """
    asked = dim.select("symbol").unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS symbol"))
    frames = {k: reports(p, asked) for k, p in TIMEFRAMES.items()}
    _view(name, frames)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted STRING, preset STRING DEFAULT '{MEDIUM}')
        RETURNS TABLE (symbol STRING, report STRING)
        RETURN SELECT wanted AS symbol, coalesce(max(report) FILTER (WHERE symbol IS NOT NULL), max(report)) AS report
            FROM {name}_reports WHERE (symbol = wanted OR symbol IS NULL) AND timeframe = {_preset(frames)}""")


def register_candle_tool(spark: SparkSession, klines: DataFrame, name: str = "tool_candles") -> None:
    """`name(wanted => symbol, preset => timeframe)`: one candle report, as `report_candles` makes it of the preset's candles.

    An unknown timeframe falls back to the medium preset, as everywhere.
    """

    def bars(p: Timeframe) -> DataFrame:
        return candle_indicators(klines, p.candle_bucket, lookback_days=p.candle_days)

    _function(spark, name, {k: report_candles(bars(p), p.candle_format) for k, p in TIMEFRAMES.items()})


def register_ticker_tool(spark: SparkSession, ticker: DataFrame, dim: DataFrame, name: str = "tool_ticker", as_of=None) -> None:
    """`name(wanted => symbol, preset => timeframe)`: one volume and liquidity report, for any symbol."""
    _answering(spark, name, dim, lambda p, asked: ticker_report(ticker, p, as_of, asked))


def register_book_tool(
    spark: SparkSession, books: DataFrame, dim: DataFrame, name: str = "tool_book", as_of=None, latest: DataFrame | None = None
) -> None:
    """`name(wanted => symbol, preset => timeframe)`: one order-book report in the preset's mode, for any symbol."""
    _answering(spark, name, dim, lambda p, asked: report_book(books, p, as_of, latest, asked))


def register_news_tool(spark: SparkSession, articles: DataFrame, dim: DataFrame, name: str = "tool_news", as_of=None) -> None:
    """`name(wanted => symbol, preset => timeframe)`: the newest articles of a symbol, for any symbol."""
    _answering(spark, name, dim, lambda p, asked: for_every_symbol(report_news(articles, p.news_days, as_of), asked, NO_NEWS))
