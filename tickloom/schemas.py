"""Table schemas as DDL strings (all instants are UTC)."""

from __future__ import annotations

SYMBOLS = "symbol string, base_asset string, quote_asset string, status string, created_at timestamp"

RAW_CANDLES = (
    "open_time bigint, open double, high double, low double, close double, volume double, "
    "close_time bigint, quote_volume double, trade_count bigint, "
    "taker_buy_base double, taker_buy_quote double"
)

CANDLES = (
    "symbol string, open_time timestamp, open double, high double, low double, close double, "
    "volume double, close_time timestamp, quote_volume double, trade_count bigint, "
    "taker_buy_base double, taker_buy_quote double, rsi_14 double, macd double"
)

TICKER = (
    "symbol string, snapshot_time timestamp, price_change double, price_change_pct double, "
    "high_24h double, low_24h double, volume_24h double, quote_volume_24h double, "
    "trade_count bigint, bid_price double, ask_price double, spread_pct double"
)

RAW_BOOK = "symbol string, timestamp timestamp, bids array<array<string>>, asks array<array<string>>"

DEPTH_MESSAGE = "lastUpdateId bigint, bids array<array<string>>, asks array<array<string>>"

BOOK = (
    "symbol string, timestamp timestamp, best_bid double, best_ask double, mid_price double, "
    "spread_pct double, depth_bid_volume double, depth_ask_volume double, obi double, "
    "bid_ask_ratio double, nearest_bid_wall_price double, nearest_bid_wall_volume double, "
    "nearest_ask_wall_price double, nearest_ask_wall_volume double"
)

ARTICLE_MESSAGE = (
    "title string, description string, content string, url string, image string, "
    "publishedAt string, source struct<name: string, url: string>"
)

NEWS = (
    "article_id string, title string, description string, content string, url string, "
    "image_url string, source_name string, source_url string, published_at timestamp, "
    "search_query string, extracted_at timestamp, symbols array<string>"
)

CHAT_HISTORY = (
    "session_id string, message_id string, timestamp timestamp, symbol string, role string, "
    "content string, timeframe string, context_summary string"
)

AGENT_TRACE = (
    "session_id string, message_id string, timestamp timestamp, supervisor_decision string, "
    "agents_called array<string>, tools_used array<string>, reasoning string, duration_ms bigint"
)

PREDICTIONS = (
    "symbol string, step_index bigint, predicted_at timestamp, target_time timestamp, "
    "predicted_close double, actual_close double"
)


def columns(ddl: str) -> list[str]:
    """Column names of a DDL string, in order."""
    depth, names, start = 0, [], 0
    for i, ch in enumerate(ddl + ","):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            names.append((ddl + ",")[start:i].split()[0])
            start = i + 1
    return names
