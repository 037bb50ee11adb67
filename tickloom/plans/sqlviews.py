"""SQL twins of the views in plans/tables.py, for the reference queries (DuckDB dialect)."""

from __future__ import annotations


def bucket(ts: str, seconds: int) -> str:
    return f"(TIMESTAMP '1970-01-01' + to_seconds(CAST(floor(epoch({ts}) / {seconds}) * {seconds} AS BIGINT)))"


SPREAD = "coalesce(({ask} - {bid}) / nullif({ask}, 0) * 100, 0)"

VIEWS = {
    "ticks": """SELECT event_type AS symbol, ts AS open_time, value AS open, value AS high, value AS low,
        value AS close, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS volume, event_id FROM events""",
    "minutes": f"""SELECT symbol, {bucket('open_time', 60)} AS open_time, arg_min(open, t) AS open, max(high) AS high,
        min(low) AS low, arg_max(close, t) AS close, sum(volume) AS volume
        FROM (SELECT *, open_time AS t FROM ticks) GROUP BY 1, 2""",
    "event_dim": """SELECT DISTINCT event_type AS symbol, upper(event_type) AS base_asset,
        CASE WHEN event_type = 'error' THEN 'BREAK' WHEN event_type <> 'signup' THEN 'TRADING' END AS status FROM events""",
    "event_ticker": f"""SELECT symbol, snapshot_time, (last - first) / nullif(first, 0) * 100 AS price_change_pct,
        volume_24h, volume_24h * 1000 AS quote_volume_24h, trade_count, bid_price, ask_price,
        {SPREAD.format(bid='bid_price', ask='ask_price')} AS spread_pct
        FROM (SELECT symbol, date_trunc('day', open_time) AS snapshot_time, arg_min(close, open_time) AS first,
            arg_max(close, open_time) AS last, max(high) AS ask_price, min(low) AS bid_price,
            sum(volume) AS volume_24h, count(*) AS trade_count FROM ticks GROUP BY 1, 2)""",
    "accounts": """SELECT 'C' || c_custkey AS symbol, c_name AS base_asset, c_mktsegment AS quote_asset,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 'BREAK' WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'TRADING' END AS status
        FROM customer""",
    "account_ticks": "SELECT 'C' || user_id AS symbol, ts AS open_time, value AS close, event_id FROM events",
    "raw_ticker": f"""SELECT 'C' || o_custkey AS symbol, o_orderdate AS snapshot_time,
        o_totalprice - 250000 AS price_change, (o_totalprice - 250000) / 2500 AS price_change_pct,
        o_totalprice / 100 AS volume_24h, o_totalprice * 10000 AS quote_volume_24h, o_orderkey AS trade_count,
        o_totalprice AS bid_price, o_totalprice + CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS ask_price,
        {SPREAD.format(bid='o_totalprice', ask='(o_totalprice + CAST(substr(o_orderpriority, 1, 1) AS DOUBLE))')} AS spread_pct,
        o_orderkey AS ingest FROM orders""",
    "ticker": """SELECT * FROM raw_ticker
        QUALIFY row_number() OVER (PARTITION BY symbol, snapshot_time ORDER BY ingest DESC) = 1""",
    "last_ticker": """SELECT * FROM ticker QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY snapshot_time DESC) = 1""",
    "levels": """SELECT 'S' || l_suppkey AS symbol, date_trunc('month', l_shipdate) AS timestamp,
        CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linenumber % 2 = 0) THEN 'bid' ELSE 'ask' END AS side,
        floor(l_extendedprice / l_quantity * 100) / 100 AS price, sum(l_quantity) AS qty
        FROM lineitem GROUP BY ALL""",
    "ranked_levels": """SELECT *, row_number() OVER (PARTITION BY symbol, timestamp, side
        ORDER BY CASE side WHEN 'bid' THEN -price ELSE price END) AS rn FROM levels""",
    "tops": """SELECT *, (best_bid + best_ask) / 2 AS mid_price FROM (
        SELECT symbol, timestamp, CASE WHEN count(DISTINCT side) = 2 THEN max(price) FILTER (WHERE side = 'bid') END AS best_bid,
            CASE WHEN count(DISTINCT side) = 2 THEN min(price) FILTER (WHERE side = 'ask') END AS best_ask
        FROM ranked_levels GROUP BY ALL)""",
    "near_levels": """SELECT r.*, sum(qty) OVER w AS total, count(*) OVER w AS n,
            row_number() OVER (PARTITION BY r.symbol, r.timestamp, side ORDER BY qty DESC, rn) AS by_qty
        FROM ranked_levels r JOIN tops t ON t.symbol = r.symbol AND t.timestamp = r.timestamp
        WHERE (side = 'bid' AND price BETWEEN mid_price * (1 - 0.5) AND mid_price)
           OR (side = 'ask' AND price BETWEEN mid_price AND mid_price * (1 + 0.5))
        WINDOW w AS (PARTITION BY r.symbol, r.timestamp, side)""",
    "books": """SELECT symbol, timestamp, best_bid, best_ask, mid_price, (best_ask - best_bid) / mid_price * 100 AS spread_pct,
            depth_bid_volume, depth_ask_volume,
            CASE WHEN depth_bid_volume + depth_ask_volume > 0
                 THEN (depth_bid_volume - depth_ask_volume) / (depth_bid_volume + depth_ask_volume)
                 WHEN mid_price IS NOT NULL THEN 0.0 END AS obi,
            CASE WHEN depth_ask_volume > 0 THEN depth_bid_volume / depth_ask_volume END AS bid_ask_ratio,
            bp AS nearest_bid_wall_price, bq AS nearest_bid_wall_volume,
            ap AS nearest_ask_wall_price, aq AS nearest_ask_wall_volume
        FROM (SELECT t.*,
                CASE WHEN mid_price IS NOT NULL THEN coalesce(v.b, 0) END AS depth_bid_volume,
                CASE WHEN mid_price IS NOT NULL THEN coalesce(v.a, 0) END AS depth_ask_volume,
                v.bp, v.bq, v.ap, v.aq
              FROM tops t LEFT JOIN (
                SELECT symbol, timestamp, sum(qty) FILTER (WHERE side = 'bid') AS b, sum(qty) FILTER (WHERE side = 'ask') AS a,
                    max(price) FILTER (WHERE side = 'bid' AND by_qty = 1 AND qty >= total / n * 3) AS bp,
                    max(qty) FILTER (WHERE side = 'bid' AND by_qty = 1 AND qty >= total / n * 3) AS bq,
                    max(price) FILTER (WHERE side = 'ask' AND by_qty = 1 AND qty >= total / n * 3) AS ap,
                    max(qty) FILTER (WHERE side = 'ask' AND by_qty = 1 AND qty >= total / n * 3) AS aq
                FROM near_levels GROUP BY ALL) v ON v.symbol = t.symbol AND v.timestamp = t.timestamp)""",
    "last_book": "SELECT * FROM books QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) = 1",
    "raw_news": r"""SELECT md5(text) AS article_id, split_part(text, chr(10), 1) AS title, text AS description,
        source AS source_name, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS published_at, lang AS search_query,
        'http://news.example.com/' || doc_id AS url, 'http://' || source || '.example.com' AS source_url, doc_id
        FROM documents""",
    "news": "SELECT * FROM raw_news QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY doc_id) = 1",
    "predictions": """SELECT o_orderpriority AS symbol, o_orderkey AS step_index, o_orderdate AS predicted_at,
        o_orderdate + INTERVAL 1 HOUR AS target_time, o_totalprice * 0.9 + c_acctbal AS predicted_close,
        CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS actual_close
        FROM orders JOIN customer ON o_custkey = c_custkey""",
}

NEEDS = {
    "minutes": ["ticks"],
    "event_ticker": ["ticks"],
    "ticker": ["raw_ticker"],
    "last_ticker": ["raw_ticker", "ticker"],
    "ranked_levels": ["levels"],
    "tops": ["levels", "ranked_levels"],
    "near_levels": ["levels", "ranked_levels", "tops"],
    "books": ["levels", "ranked_levels", "tops", "near_levels"],
    "last_book": ["levels", "ranked_levels", "tops", "near_levels", "books"],
    "news": ["raw_news"],
}


def with_views(*names: str, recursive: bool = False, **extra: str) -> str:
    """WITH clause for the named views and what they need; `extra` adds further CTEs in order."""
    order: list[str] = []
    for name in names:
        for item in [*NEEDS.get(name, []), name]:
            if item not in order:
                order.append(item)
    parts = [f"{n} AS ({VIEWS[n]})" for n in order] + [f"{n} AS ({s})" for n, s in extra.items()]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


def candles(source: str, ts: str, expr: str, extra: str = "", where: str = "") -> str:
    """OHLCV per symbol and bucket expression."""
    return (
        f"SELECT symbol, {expr} AS ts, arg_min(open, {ts}) AS open, max(high) AS high, min(low) AS low, "
        f"arg_max(close, {ts}) AS close, sum(volume) AS volume{extra} FROM {source} {where} GROUP BY 1, 2"
    )


def numbered(source: str, ts: str) -> str:
    return (
        f"SELECT symbol, {ts} AS ts, close, row_number() OVER (PARTITION BY symbol ORDER BY {ts}) AS rn FROM {source}"
    )


def momentum_cte() -> str:
    """Recursive pass over CTE `n` (symbol, ts, close, rn): gain/loss means and the two EMAs."""
    a14, a12, a26 = "(2.0::DOUBLE/15)", "(2.0::DOUBLE/13)", "(2.0::DOUBLE/27)"
    up = "greatest(n.close - r.close, 0)"
    down = "greatest(r.close - n.close, 0)"
    return f"""SELECT symbol, ts, close, rn, CAST(NULL AS DOUBLE) AS g, CAST(NULL AS DOUBLE) AS l, close AS e12, close AS e26
        FROM n WHERE rn = 1
      UNION ALL
      SELECT n.symbol, n.ts, n.close, n.rn,
        CASE WHEN r.g IS NULL THEN {up} ELSE (1 - {a14}) * r.g + {a14} * {up} END,
        CASE WHEN r.l IS NULL THEN {down} ELSE (1 - {a14}) * r.l + {a14} * {down} END,
        (1 - {a12}) * r.e12 + {a12} * n.close, (1 - {a26}) * r.e26 + {a26} * n.close
      FROM r JOIN n ON n.symbol = r.symbol AND n.rn = r.rn + 1"""


RSI_OF_MEANS = "CASE WHEN g IS NULL OR (g = 0 AND l = 0) THEN 0.0 WHEN l = 0 THEN 100.0 ELSE 100 - 100 / (1 + g / l) END"

ZONE = """CASE WHEN {0} >= 70 THEN 'Overbought' WHEN {0} >= 60 THEN 'Strong' WHEN {0} >= 40 THEN 'Neutral'
    WHEN {0} >= 30 THEN 'Weak' ELSE 'Oversold' END"""

TAG = """CASE WHEN {0} >= 0.30 THEN 'strong bid pressure' WHEN {0} <= -0.30 THEN 'strong ask pressure'
    WHEN {0} > 0.10 THEN 'mild bid pressure' WHEN {0} < -0.10 THEN 'mild ask pressure' ELSE 'balanced' END"""


def rsi_sma_ctes(source: str) -> dict[str, str]:
    """CTEs that end in `s` (symbol, ts, close, rsi) over candles CTE `source`."""
    return {
        "d": f"SELECT symbol, ts, close, close - lag(close) OVER (PARTITION BY symbol ORDER BY ts) AS delta FROM {source}",
        "g": """SELECT symbol, ts, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS pn,
            avg(CASE WHEN delta > 0 THEN delta ELSE 0 END) OVER w AS ag,
            avg(CASE WHEN delta < 0 THEN -delta ELSE 0 END) OVER w AS al FROM d
            WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
        "s": """SELECT symbol, ts, close, CASE WHEN pn < 15 THEN NULL WHEN ag = 0 AND al = 0 THEN 50.0
            WHEN al = 0 THEN 100.0 ELSE 100 - 100 / (1 + ag / al) END AS rsi FROM g""",
    }
