"""Ticker transform, trends, tops, panels, snapshot joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.numbers import compact_usd, price_text
from tickloom.operators import ticker as K
from tickloom.operators.latest import latest_by_key, top_n
from tickloom.plans import sqlviews as V
from tickloom.plans.registry import query
from tickloom.sources.messages import parse_ticker_json
from tickloom.vocab import TICKER_COLUMNS

LATEST = ("snapshot_time", "ingest")


def wire_ticker(t):
    """Orders as wire-level ticker objects: text numbers, urgent orders without a numeric ask."""
    price = F.col("o_totalprice")
    step = F.substring("o_orderpriority", 1, 1).cast("int")
    ask = F.when(step == 1, "n/a").otherwise((price + step).cast("string"))
    return t.read("orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"),
        price.cast("string").alias("highPrice"),
        price.cast("string").alias("quoteVolume"),
        F.col("o_orderkey").cast("string").alias("count"),
        price.cast("string").alias("bidPrice"),
        ask.alias("askPrice"),
    )


ASK = "CASE WHEN substr(o_orderpriority, 1, 1) <> '1' THEN o_totalprice + CAST(substr(o_orderpriority, 1, 1) AS INT) END"


@query(
    "ticker_transform",
    f"""SELECT 'C' || o_custkey AS symbol, (SELECT max(o_orderdate) FROM orders) AS snapshot_time,
        CAST(NULL AS DOUBLE) AS price_change, CAST(NULL AS DOUBLE) AS price_change_pct, o_totalprice AS high_24h,
        CAST(NULL AS DOUBLE) AS low_24h, CAST(NULL AS DOUBLE) AS volume_24h, o_totalprice AS quote_volume_24h,
        o_orderkey AS trade_count, o_totalprice AS bid_price, {ASK} AS ask_price,
        round(coalesce(({ASK} - o_totalprice) / {ASK} * 100, 0), 9) AS spread_pct FROM orders""",
)
def ticker_transform(t):
    """Wire names to columns, one snapshot time, spread over ask, absent columns NULL."""
    as_of = t.read("orders").select(F.max("o_orderdate")).scalar()
    out = K.ticker_transform(wire_ticker(t), as_of)
    numbers = {c: F.col(c).try_cast("double") for c in out.columns if c not in ("symbol", "snapshot_time")}
    numbers["trade_count"] = F.col("trade_count").try_cast("bigint")
    numbers["spread_pct"] = F.round("spread_pct", 9)
    return out.withColumns(numbers)


@query(
    "ticker_symbol_filter",
    """SELECT 'C' || o_custkey AS symbol, CAST(o_totalprice AS DOUBLE) AS quote_volume FROM orders
        WHERE 'C' || o_custkey IN (SELECT 'C' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def ticker_symbol_filter(t):
    """Ticker objects from JSON arrays, kept for tracked symbols only."""
    fields = ["symbol", *[c for c in TICKER_COLUMNS if c in wire_ticker(t).columns]]
    wire = wire_ticker(t).select(F.to_json(F.array(F.struct(*fields))).alias("body"))
    dim = t.accounts().where(F.col("quote_asset") == "BUILDING")
    rows = K.tracked(parse_ticker_json(wire, "body"), dim)
    return rows.select("symbol", F.col("quoteVolume").try_cast("double").alias("quote_volume"))


@query(
    "spread_daily",
    V.with_views("ticker")
    + """SELECT symbol, CAST(snapshot_time AS DATE) AS day, round(avg(spread_pct), 6) AS avg_spread_pct,
        round(max(spread_pct), 6) AS max_spread_pct, round(min(spread_pct), 6) AS min_spread_pct FROM ticker
        WHERE snapshot_time >= (SELECT max(snapshot_time) FROM ticker) - INTERVAL 30 DAY GROUP BY 1, 2""",
)
def spread_daily(t):
    return K.spread_daily(t.ticker(), 30, t.ticker_as_of())


def _trend(name, size, days, expr):
    sql = V.with_views("ticker") + f"""SELECT symbol, {expr} AS ts, round(avg(price_change_pct), 8) AS avg_price_change_pct,
        round(avg(volume_24h), 8) AS avg_volume_24h, round(avg(spread_pct), 8) AS avg_spread_pct,
        round(avg(trade_count), 8) AS avg_trade_count FROM ticker
        WHERE snapshot_time >= (SELECT max(snapshot_time) FROM ticker) - INTERVAL {days} DAY GROUP BY 1, 2"""

    def run(t):
        out = K.ticker_trend(t.ticker(), size, days, t.ticker_as_of())
        return out.withColumns({c: F.round(c, 8) for c in out.columns if c.startswith("avg_")})

    query(name, sql)(run)


_trend("ticker_trend_hour", "hour", 3, "date_trunc('hour', snapshot_time)")
_trend("ticker_trend_day", "day", 30, "date_trunc('day', snapshot_time)")
_trend(
    "ticker_trend_week", "week", 730,
    "date_trunc('day', snapshot_time) - to_days(CAST(dayofweek(snapshot_time) AS INTEGER))",
)
_trend("ticker_trend_month", "month", 1095, "date_trunc('month', snapshot_time)")


@query(
    "latest_ticker",
    V.with_views("last_ticker") + "SELECT symbol, price_change_pct, volume_24h, spread_pct FROM last_ticker",
)
def latest_ticker(t):
    return K.latest_ticker(t.raw_ticker(), LATEST)


@query(
    "top_volume",
    V.with_views("last_ticker")
    + """SELECT symbol, quote_volume_24h, round(quote_volume_24h / 1000000000, 2) AS quote_volume_billion_usd
        FROM last_ticker ORDER BY quote_volume_24h DESC, symbol LIMIT 10""",
)
def top_volume(t):
    top = K.top_by_latest(t.raw_ticker(), "quote_volume_24h", order=LATEST)
    return K.with_billions(top.select("symbol", "quote_volume_24h"), "quote_volume_24h", "quote_volume_billion_usd")


def _movers(name, ascending):
    way = "ASC" if ascending else "DESC"
    sql = V.with_views("last_ticker") + f"""SELECT symbol, price_change_pct, quote_volume_24h FROM last_ticker
        ORDER BY price_change_pct {way}, symbol LIMIT 10"""

    def run(t):
        top = K.top_by_latest(t.raw_ticker(), "price_change_pct", ascending=ascending, order=LATEST)
        return top.select("symbol", "price_change_pct", "quote_volume_24h")

    query(name, sql)(run)


_movers("top_gainers", False)
_movers("top_losers", True)

AT_LATEST = """FROM event_ticker t JOIN event_dim s ON s.symbol = t.symbol
    WHERE snapshot_time = (SELECT max(snapshot_time) FROM event_ticker)"""


@query(
    "panel_top_volume",
    V.with_views("event_ticker", "event_dim")
    + f"SELECT base_asset AS coin, quote_volume_24h AS volume_usd {AT_LATEST} ORDER BY 2 DESC, t.symbol LIMIT 10",
)
def panel_top_volume(t):
    top = K.top_at_global_latest(t.event_ticker(), t.event_dim(), "quote_volume_24h", 10, newest=t.event_day())
    return top.select(F.col("base_asset").alias("coin"), F.col("quote_volume_24h").alias("volume_usd"))


@query(
    "panel_volume_billions",
    V.with_views("event_ticker", "event_dim")
    + f"""SELECT base_asset AS coin, round(quote_volume_24h / 1000000000, 2) AS volume_billion_usd {AT_LATEST}
        ORDER BY quote_volume_24h DESC, t.symbol LIMIT 10""",
)
def panel_volume_billions(t):
    top = K.top_at_global_latest(t.event_ticker(), t.event_dim(), "quote_volume_24h", 10, newest=t.event_day())
    named = K.with_billions(top, "quote_volume_24h", "volume_billion_usd")
    return named.select(F.col("base_asset").alias("coin"), "volume_billion_usd")


CELLS = 'base_asset AS "Coin", round(price_change_pct, 2) AS "24h %", round(quote_volume_24h, 2) AS "Vol"'


def _cells(df):
    return df.select(
        F.col("base_asset").alias("Coin"),
        F.round("price_change_pct", 2).alias("24h %"),
        F.round("quote_volume_24h", 2).alias("Vol"),
    )


@query(
    "panel_losers",
    V.with_views("event_ticker", "event_dim")
    + f"SELECT {CELLS} {AT_LATEST} AND price_change_pct < 0 ORDER BY price_change_pct, t.symbol LIMIT 5",
)
def panel_losers(t):
    falling = F.col("price_change_pct") < 0
    return _cells(K.top_at_global_latest(t.event_ticker(), t.event_dim(), "price_change_pct", 5, True, falling, t.event_day()))


@query(
    "panel_gainers_positive",
    V.with_views("event_ticker", "event_dim")
    + f"""SELECT base_asset AS coin, price_change_pct, quote_volume_24h {AT_LATEST} AND price_change_pct > 0
        ORDER BY price_change_pct DESC, t.symbol LIMIT 5""",
)
def panel_gainers_positive(t):
    rising = F.col("price_change_pct") > 0
    top = K.top_at_global_latest(t.event_ticker(), t.event_dim(), "price_change_pct", 5, where=rising, newest=t.event_day())
    return top.select(F.col("base_asset").alias("coin"), "price_change_pct", "quote_volume_24h")


@query(
    "panel_gainers",
    V.with_views("last_ticker", "accounts")
    + f"""SELECT {CELLS} FROM last_ticker t JOIN accounts s ON s.symbol = t.symbol
        ORDER BY price_change_pct DESC, t.symbol LIMIT 5""",
)
def panel_gainers(t):
    """Top 5 by newest change of each symbol, whatever its sign."""
    newest = latest_by_key(t.raw_ticker(), ["symbol"], LATEST)
    return _cells(top_n(newest.join(t.accounts(), "symbol"), "price_change_pct", 5, ["symbol"]))


@query(
    "market_snapshot",
    V.with_views("accounts", "account_ticks", "last_ticker")
    + """SELECT s.symbol, s.base_asset, k.latest_kline_time, k.latest_close, t.price_change_pct AS change_24h_pct
        FROM accounts s LEFT JOIN (SELECT symbol, max(open_time) AS latest_kline_time, arg_max(close, open_time) AS latest_close
            FROM account_ticks GROUP BY 1) k ON s.symbol = k.symbol
        LEFT JOIN last_ticker t ON s.symbol = t.symbol""",
)
def market_snapshot(t):
    """Accounts without events have no candle: their columns stay NULL."""
    return K.market_snapshot(t.accounts(), t.account_ticks(), t.raw_ticker(), LATEST)


@query(
    "latest_by_key",
    V.with_views("ticker") + "SELECT symbol, snapshot_time, quote_volume_24h, ingest FROM ticker",
)
def latest_by_key_q(t):
    rows = t.raw_ticker().select("symbol", "snapshot_time", "quote_volume_24h", "ingest")
    return latest_by_key(rows, ["symbol", "snapshot_time"], ["ingest"])


USD = """CASE WHEN v >= 1e12 THEN '$' || CASE WHEN v >= 1e13 THEN format('{:.0f}', v / 1e12) ELSE format('{:.1f}', v / 1e12) END || 'T'
    WHEN v >= 1e9 THEN '$' || CASE WHEN v >= 1e10 THEN format('{:.0f}', v / 1e9) ELSE format('{:.1f}', v / 1e9) END || 'B'
    WHEN v >= 1e6 THEN '$' || CASE WHEN v >= 1e7 THEN format('{:.0f}', v / 1e6) ELSE format('{:.1f}', v / 1e6) END || 'M'
    WHEN v >= 1e3 THEN '$' || format('{:.0f}', v / 1e3) || 'K' ELSE '$' || format('{:.0f}', v) END"""


@query(
    "format_usd",
    f"""SELECT k, n, {USD} AS usd FROM (SELECT o_orderkey AS k, n, o_totalprice * power(10, n) AS v
        FROM orders, (SELECT unnest([-4, -2, 0, 2, 4, 6, 8]) AS n))""",
)
def format_usd(t):
    """Order totals at seven magnitudes."""
    powers = F.array(*[F.lit(p) for p in (-4, -2, 0, 2, 4, 6, 8)])
    rows = t.read("orders").select(F.col("o_orderkey").alias("k"), "o_totalprice", F.explode(powers).alias("n"))
    return rows.select("k", "n", compact_usd(F.col("o_totalprice") * F.pow(F.lit(10.0), "n")).alias("usd"))


@query(
    "format_price",
    """SELECT k, n, CASE WHEN v >= 1000 THEN '$' || regexp_replace(regexp_replace(format('{:,.2f}', v), '0+$', ''), '\\.$', '')
        WHEN v >= 1 THEN '$' || format('{:.2f}', v) WHEN v >= 0.01 THEN '$' || format('{:.4f}', v)
        WHEN v >= 0.001 THEN '$' || format('{:.6f}', v) WHEN v >= 0.0001 THEN '$' || format('{:.7f}', v)
        ELSE '$' || format('{:.8f}', v) END AS price
        FROM (SELECT o_orderkey AS k, n, o_totalprice * power(10, n) AS v FROM orders, (SELECT unnest([-8, -6, -4, -2, 0]) AS n))""",
)
def format_price(t):
    """Order totals at five magnitudes as prices."""
    powers = F.array(*[F.lit(p) for p in (-8, -6, -4, -2, 0)])
    rows = t.read("orders").select(F.col("o_orderkey").alias("k"), "o_totalprice", F.explode(powers).alias("n"))
    return rows.select("k", "n", price_text(F.col("o_totalprice") * F.pow(F.lit(10.0), "n")).alias("price"))
