"""Timeframe presets: how far back each report looks and how coarsely it buckets.

The numbers, modes and labels are fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Timeframe:
    label: str
    candle_bucket: int | str
    candle_days: int
    candle_limit: int
    candle_format: str
    ticker_bucket: int | str
    ticker_days: int
    book_mode: str
    news_days: int
    book_bucket: int | str | None = None
    book_days: int | None = None


TIMEFRAMES = {
    "short": Timeframe(
        label="Short-term (hours → days)",
        candle_bucket="hour", candle_days=20, candle_limit=480, candle_format="yyyy-MM-dd HH:00",
        ticker_bucket="hour", ticker_days=3,
        book_mode="trend", book_bucket="hour", book_days=3,
        news_days=3,
    ),
    "medium": Timeframe(
        label="Medium-term (weeks → month)",
        candle_bucket=4 * 3600, candle_days=90, candle_limit=540, candle_format="yyyy-MM-dd HH:00",
        ticker_bucket="day", ticker_days=30,
        book_mode="trend", book_bucket="day", book_days=30,
        news_days=14,
    ),
    "long": Timeframe(
        label="Long-term (months → 1 year)",
        candle_bucket="day", candle_days=730, candle_limit=730, candle_format="yyyy-MM-dd",
        ticker_bucket="week", ticker_days=730,
        book_mode="summary_30d",
        news_days=30,
    ),
    "very_long": Timeframe(
        label="Very long-term (1 → 3+ years)",
        candle_bucket="day", candle_days=1095, candle_limit=1095, candle_format="yyyy-MM-dd",
        ticker_bucket="month", ticker_days=1095,
        book_mode="latest_only",
        news_days=90,
    ),
}


def timeframe(name: str) -> Timeframe:
    """Preset by name; an unknown name falls back to the medium preset."""
    return TIMEFRAMES.get(name, TIMEFRAMES["medium"])
