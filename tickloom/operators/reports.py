"""Plain-text market reports, one per symbol.

A report lists a preset-bounded number of lines (candle limit, days of buckets, 15 articles), so
the per-symbol line array is small by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.labels import obi_tag
from tickloom.functions.numbers import finite_or, fixed
from tickloom.functions.text import text_or_empty
from tickloom.functions.times import instant
from tickloom.operators.indicators import candle_indicators
from tickloom.operators.orderbook import ob_latest, ob_summary, ob_trend
from tickloom.operators.news import news_per_symbol
from tickloom.operators.signals import SIGNALS, signal_lines, with_signals
from tickloom.operators.ticker import latest_ticker, ticker_trend
from tickloom.presets import Timeframe
from tickloom.vocab import NO_TICKER


#: Characters of a title and of a description that the report format prints.
TITLE_CHARS, TEXT_CHARS = 120, 200

#: Numbers that the reports print of the newest ticker snapshot, the newest book and the 30-day summary.
SNAPSHOT_NUMBERS = ("price_change_pct", "volume_24h", "spread_pct")
BOOK_NUMBERS = ("obi", "depth_bid_volume", "depth_ask_volume", "bid_ask_ratio", "spread_pct")
SUMMARY_NUMBERS = ("avg_obi", "min_obi", "max_obi", "latest_obi")


def _stamp(ts: str, pattern: str) -> Column:
    return F.date_format(instant(F.col(ts)), pattern)


def _block(df: DataFrame, order: str, line: Column, out: str) -> DataFrame:
    """Lines of every symbol joined in `order`."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l"))))
    return df.groupBy("symbol").agg(F.concat_ws("\n", F.transform(packed, lambda x: x["l"])).alias(out))


def _candle_line(pattern: str) -> Column:
    prices = [
        part
        for name, tag in (("open", " O:"), ("high", " H:"), ("low", " L:"), ("close", " C:"))
        for part in (F.lit(tag), fixed(F.col(name), 4))
    ]
    return F.concat(
        _stamp("ts", pattern),
        *prices,
        F.lit(" V:"),
        fixed(F.col("volume"), 0, comma=True),
        F.lit(" RSI:"),
        fixed(finite_or(F.col("rsi_14"), 50), 1),
    )


def report_candles(df: DataFrame, pattern: str) -> DataFrame:
    """One line per candle."""
    return _block(df, "ts", _candle_line(pattern), "report")


def _of_every_symbol(rows: DataFrame, dim: DataFrame | None, numbers: Sequence[str]) -> DataFrame:
    """`rows` for each symbol of `dim`, numbers of a symbol without a row read 0; `rows` as they are without a dimension."""
    if dim is None:
        return rows
    joined = dim.select("symbol").distinct().join(rows, "symbol", "left")
    return joined.select("symbol", *[finite_or(F.col(c), 0).alias(c) for c in numbers])


def report_ticker(trend: DataFrame, latest: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Trend lines followed by the newest snapshot; with `dim` for each of its symbols, also for those without rows."""
    latest = _of_every_symbol(latest, dim, SNAPSHOT_NUMBERS)
    line = F.concat(
        _stamp("ts", "yyyy-MM-dd"),
        F.lit(" Vol:"),
        fixed(finite_or(F.col("avg_volume_24h"), 0), 0, comma=True),
        F.lit(" Spread:"),
        fixed(finite_or(F.col("avg_spread_pct"), 0), 4),
        F.lit("% PriceChg:"),
        fixed(finite_or(F.col("avg_price_change_pct"), 0), 2, plus=True),
        F.lit("%"),
    )
    tail = F.concat(
        F.lit("\n\n--- Latest 24h snapshot ---\nPrice change: "),
        fixed(F.col("price_change_pct"), 2, plus=True),
        F.lit("%\nVolume 24h: "),
        fixed(F.col("volume_24h"), 0, comma=True),
        F.lit("\nBid-ask spread: "),
        fixed(F.col("spread_pct"), 4),
        F.lit("%"),
    )
    body = F.coalesce("trend", F.lit(NO_TICKER))
    return (
        latest.join(_block(trend, "ts", line, "trend"), "symbol", "left")
        .select("symbol", F.concat(body, tail).alias("report"))
    )


def _signed(x: Column) -> Column:
    return fixed(finite_or(x, 0), 3, plus=True)


def _with_tag(x: Column) -> Column:
    return F.concat(_signed(x), F.lit(" ("), obi_tag(finite_or(x, 0)), F.lit(")"))


def report_book_latest(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Newest snapshot (made by `ob_latest`); `dim` as in `report_ticker`."""
    return _of_every_symbol(df, dim, BOOK_NUMBERS).select(
        "symbol",
        F.concat(
            F.lit("Live Liquidity Pressure:\n  OBI (±0.5% depth): "),
            _with_tag(F.col("obi")),
            F.lit("\n  Bid Volume: "),
            fixed(F.col("depth_bid_volume"), 2, comma=True),
            F.lit(" / Ask Volume: "),
            fixed(F.col("depth_ask_volume"), 2, comma=True),
            F.lit("\n  Bid/Ask Ratio: "),
            fixed(F.col("bid_ask_ratio"), 2),
            F.lit("x\n  Spread: "),
            fixed(F.col("spread_pct"), 4),
            F.lit("%"),
        ).alias("report"),
    )


def report_book_summary(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """30-day summary (made by `ob_summary`); `dim` as in `report_ticker`."""
    return _of_every_symbol(df, dim, SUMMARY_NUMBERS).select(
        "symbol",
        F.concat(
            F.lit("30-day order book summary:\n  Avg OBI: "),
            _signed(F.col("avg_obi")),
            F.lit("\n  Min: "),
            _signed(F.col("min_obi")),
            F.lit(" / Max: "),
            _signed(F.col("max_obi")),
            F.lit("\n  Latest: "),
            _with_tag(F.col("latest_obi")),
        ).alias("report"),
    )


def report_book_trend(trend: DataFrame, latest: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Newest imbalance followed by the bucketed trend; `dim` as in `report_ticker`."""
    latest = _of_every_symbol(latest, dim, ["obi"])
    line = F.concat(
        F.lit("  "),
        _stamp("ts", "yyyy-MM-dd HH:00"),
        F.lit(" OBI:"),
        _signed(F.col("avg_obi")),
        F.lit(" Bid:"),
        fixed(finite_or(F.col("avg_bid_vol"), 0), 0, comma=True),
        F.lit(" Ask:"),
        fixed(finite_or(F.col("avg_ask_vol"), 0), 0, comma=True),
    )
    head = F.concat(F.lit("Current OBI: "), _with_tag(F.col("obi")))
    tail = F.coalesce(F.concat(F.lit("\nOrder book trend:\n"), F.col("trend")), F.lit(""))
    return (
        latest.join(_block(trend, "ts", line, "trend"), "symbol", "left")
        .select("symbol", F.concat(head, tail).alias("report"))
    )


def report_book(
    df: DataFrame, preset: Timeframe, as_of=None, latest: DataFrame | None = None, dim: DataFrame | None = None, month: str | None = None
) -> DataFrame:
    """Order-book report in the preset's mode; `latest` may hold the newest snapshots already.

    With `dim` there is one report for each of its symbols; where a symbol has no books its numbers read 0 and
    there is no trend. `month` names a 'yyyy-MM' partition column to prune the lookback by.
    """
    newest = df if latest is None else latest
    if preset.book_mode == "latest_only":
        return report_book_latest(ob_latest(newest), dim)
    if preset.book_mode == "summary_30d":
        return report_book_summary(ob_summary(df, 30, as_of, month), dim)
    return report_book_trend(ob_trend(df, preset.book_bucket, preset.book_days, as_of, month), ob_latest(newest), dim)


def report_news(
    df: DataFrame, days: int, as_of=None, title_chars: int | None = TITLE_CHARS, text_chars: int | None = TEXT_CHARS
) -> DataFrame:
    """Newest articles of every symbol; titles and descriptions are printed up to so many characters, whole if None."""

    def printed_part(name: str, most: int | None) -> Column:
        text = text_or_empty(F.col(name))
        return (text if most is None else F.substring(text, 1, most)).alias(name)

    # the printed parts only, so that whole article texts are not sorted and shuffled
    printed = df.select(
        "article_id",
        "published_at",
        "symbols",
        printed_part("title", title_chars),
        printed_part("description", text_chars),
        text_or_empty(F.col("source_name")).alias("source"),
    )
    line = F.concat_ws(
        "\n",
        F.concat(F.lit("["), _stamp("published_at", "yyyy-MM-dd HH:mm"), F.lit("] "), F.col("title")),
        F.when(F.col("description") != "", F.concat(F.lit("  "), F.col("description"))),
        F.when(F.col("source") != "", F.concat(F.lit("  Source: "), F.col("source"))),
    )
    return _block(news_per_symbol(printed, days, as_of), "rank", line, "report")


def for_every_symbol(reports: DataFrame, dim: DataFrame, missing: str) -> DataFrame:
    """A report for each symbol of the dimension; `missing` (NO_CANDLES, NO_NEWS) where it has no rows to report."""
    return dim.select("symbol").distinct().join(reports, "symbol", "left").select(
        "symbol", F.coalesce("report", F.lit(missing)).alias("report")
    )


def market_report(klines: DataFrame, preset: Timeframe, as_of=None, digits: int = 6) -> DataFrame:
    """Candle report, summary and signals per symbol for a timeframe preset."""
    bars = candle_indicators(
        klines, preset.candle_bucket, lookback_days=preset.candle_days, as_of=as_of
    )
    # one pass per symbol: lines, count, last values and last signals
    packed = F.array_sort(F.collect_list(F.struct("ts", _candle_line(preset.candle_format).alias("l"))))
    last = ("close", "rsi_14", "macd", *[f"signal_{s}" for s in SIGNALS])
    whole = with_signals(bars).groupBy("symbol").agg(
        F.concat_ws("\n", F.transform(packed, lambda x: x["l"])).alias("lines"),
        F.count(F.lit(1)).alias("n"),
        *[F.max_by(c, "ts").alias(c) for c in last],
    )
    summary = F.concat(
        F.lit("\n\n--- Summary ---\nCandles: "),
        F.col("n").cast("string"),
        F.lit(f" ({preset.label})\nLatest close: "),
        fixed(F.col("close"), 4),
        F.lit("\nRSI(14): "),
        fixed(F.col("rsi_14"), digits),
        F.lit("\nMACD: "),
        fixed(F.col("macd"), digits),
    )
    block = F.concat(F.lit("\n\n"), signal_lines(lambda s: F.col(f"signal_{s}")))
    tail = F.when(F.col("n") >= 2, block).otherwise("")
    return whole.select("symbol", F.concat("lines", summary, tail).alias("report"))


def ticker_report(ticker: DataFrame, preset: Timeframe, as_of=None, dim: DataFrame | None = None, month: str | None = None) -> DataFrame:
    """Volume and liquidity report for a timeframe preset; `dim` as in `report_ticker`, `month` as in `report_book`."""
    trend = ticker_trend(ticker, preset.ticker_bucket, preset.ticker_days, as_of, month)
    return report_ticker(trend, latest_ticker(ticker), dim)
