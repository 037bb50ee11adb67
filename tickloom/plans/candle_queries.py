"""Candles, indicators, heatmap, signals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.functions.labels import rsi_zone
from tickloom.operators import candles as C
from tickloom.operators import indicators as I
from tickloom.operators import load as L
from tickloom.operators.ewm import Mean, ewm
from tickloom.operators.heatmap import rsi_heatmap
from tickloom.operators.latest import latest_by_key, oldest_n
from tickloom.operators.signals import signals
from tickloom.operators.ticker import latest_rsi
from tickloom.plans import sqlviews as V
from tickloom.plans.registry import query

BARS = "symbol, ts, open, high, low, close, volume"
CHART = (dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 19))
#: Hours that a chart spans, and the bucket seconds it must pick.
CHART_HOURS = [(6, 60), (24, 300), (72, 900), (168, 3600), (1000, 43200), (5000, 86400), (20000, 604800)]


def _bars(name, size, expr):
    sql = V.with_views("ticks", c=V.candles("ticks", "open_time", expr)) + f"SELECT {BARS} FROM c"
    query(name, sql)(lambda t: C.candles(t.ticks(), size))


_bars("candles_1h", "hour", "date_trunc('hour', open_time)")
_bars("candles_4h", 4 * 3600, V.bucket("open_time", 14400))
_bars("candles_1d", "day", "date_trunc('day', open_time)")


@query(
    "candles_adaptive",
    V.with_views("ticks")
    + f"""SELECT symbol, {V.bucket('t', 14400)} AS ts, arg_min(open, t) AS open, max(high) AS high, min(low) AS low,
        arg_max(close, t) AS close, round(sum(close * volume), 4) AS volume
        FROM (SELECT *, open_time AS t FROM ticks)
        WHERE t BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-19' GROUP BY 1, 2""",
)
def candles_adaptive(t):
    """A 14-day chart picks 4-hour buckets."""
    return C.candles_between(t.ticks(), *CHART).withColumn("volume", F.round("volume", 4))


def _chart(name: str, hours: float, width: int) -> None:
    """A chart of the last `hours` hours before 2024-01-19 picks buckets of `width` seconds."""
    end = dt.datetime(2024, 1, 19)
    start = end - dt.timedelta(hours=hours)
    sql = V.with_views("ticks") + f"""SELECT symbol, {V.bucket('t', width)} AS ts, arg_min(open, t) AS open, max(high) AS high,
        min(low) AS low, arg_max(close, t) AS close, round(sum(close * volume), 4) AS volume
        FROM (SELECT *, open_time AS t FROM ticks) WHERE t BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}' GROUP BY 1, 2"""
    query(name, sql)(lambda t: C.candles_between(t.ticks(), start, end).withColumn("volume", F.round("volume", 4)))


for _hours, _width in CHART_HOURS:
    _chart(f"candles_adaptive_{_width}s", _hours, _width)


@query(
    "candles_in_list",
    V.with_views("ticks", c=V.candles("ticks", "open_time", "date_trunc('day', open_time)", where="WHERE symbol IN ('view', 'click')"))
    + f"SELECT {BARS} FROM c",
)
def candles_in_list(t):
    """Daily candles of listed symbols only."""
    return C.candles(t.ticks().where(F.col("symbol").isin("view", "click")), "day")


@query(
    "candles_limit",
    V.with_views("ticks")
    + f"""SELECT {BARS} FROM ({V.candles('ticks', 'open_time', "date_trunc('hour', open_time)",
        where="WHERE open_time >= (SELECT max(open_time) FROM ticks) - INTERVAL 20 DAY")})
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts) <= 480""",
)
def candles_limit(t):
    """Oldest 480 hourly candles of the last 20 days."""
    return C.candles(t.ticks(), "hour", lookback_days=20, limit=480)


@query(
    "ewm",
    V.with_views(
        "minutes",
        recursive=True,
        n=V.numbered("minutes", "open_time"),
        r="""SELECT symbol, ts, rn, close AS y FROM n WHERE rn = 1 UNION ALL
            SELECT n.symbol, n.ts, n.rn, (1 - 2.0::DOUBLE / 13) * r.y + (2.0::DOUBLE / 13) * n.close
            FROM r JOIN n ON n.symbol = r.symbol AND n.rn = r.rn + 1""",
    )
    + "SELECT symbol, ts AS open_time, round(y, 6) AS ema_12 FROM r",
)
def ewm_12(t):
    out = ewm(t.minutes(), "symbol", "open_time", 60, [Mean("close", 12, "ema_12")])
    return out.select("symbol", "open_time", F.round("ema_12", 6).alias("ema_12"))


def _momentum(source, ts):
    return dict(n=V.numbered(source, ts), r=V.momentum_cte())


@query(
    "rsi_ewm",
    V.with_views("minutes", recursive=True, **_momentum("minutes", "open_time"))
    + f"SELECT symbol, ts AS open_time, round({V.RSI_OF_MEANS}, 6) AS rsi_14 FROM r",
)
def rsi_ewm(t):
    out = I.rsi_ewm(t.minutes().select("symbol", "open_time", "close"))
    return out.select("symbol", "open_time", F.round("rsi_14", 6).alias("rsi_14"))


@query(
    "macd",
    V.with_views(
        "minutes",
        recursive=True,
        **_momentum("minutes", "open_time"),
        s="""SELECT symbol, ts, rn, e12 - e26 AS m, e12 - e26 AS sig FROM r WHERE rn = 1 UNION ALL
            SELECT r.symbol, r.ts, r.rn, r.e12 - r.e26, 0.8::DOUBLE * s.sig + 0.2::DOUBLE * (r.e12 - r.e26)
            FROM s JOIN r ON r.symbol = s.symbol AND r.rn = s.rn + 1""",
    )
    + "SELECT symbol, ts AS open_time, round(m, 6) AS macd, round(sig, 6) AS macd_signal FROM s",
)
def macd(t):
    out = I.macd(t.minutes().select("symbol", "open_time", "close"))
    return out.select(
        "symbol", "open_time", F.round("macd", 6).alias("macd"), F.round("macd_signal", 6).alias("macd_signal")
    )


MEDIUM = V.candles(
    "ticks", "open_time", V.bucket("open_time", 14400),
    where="WHERE open_time >= (SELECT max(open_time) FROM ticks) - INTERVAL 90 DAY",
)
INDICATED = V.with_views("ticks", recursive=True, c=MEDIUM, **_momentum("c", "ts"))


def _medium(t):
    return I.candle_indicators(t.ticks(), 4 * 3600, lookback_days=90)


@query(
    "candles_indicators",
    INDICATED
    + f"""SELECT c.symbol, c.ts, c.open, c.high, c.low, c.close, c.volume, round({V.RSI_OF_MEANS}, 6) AS rsi_14,
        round(e12 - e26, 6) AS macd FROM c JOIN r ON r.symbol = c.symbol AND r.ts = c.ts""",
)
def candles_indicators(t):
    """Medium preset: 4-hour candles of 90 days with RSI and MACD of the buckets."""
    return _medium(t).withColumns({c: F.round(c, 6) for c in ("rsi_14", "macd")})


@query(
    "latest_rsi",
    V.with_views("minutes", recursive=True, **_momentum("minutes", "open_time"))
    + f"SELECT symbol, max(ts) AS latest_time, round(arg_max({V.RSI_OF_MEANS}, ts), 6) AS latest_rsi FROM r GROUP BY 1",
)
def latest_rsi_q(t):
    out = latest_rsi(I.momentum(t.minutes().select("symbol", "open_time", "close")))
    return out.withColumn("latest_rsi", F.round("latest_rsi", 6)).orderBy(F.col("latest_rsi").desc_nulls_last())


@query(
    "lateral_latest",
    V.with_views("minutes", "event_dim", recursive=True, **_momentum("minutes", "open_time"))
    + f"""SELECT base_asset AS coin, round({V.RSI_OF_MEANS}, 6) AS rsi_14 FROM event_dim d JOIN r ON r.symbol = d.symbol
        QUALIFY row_number() OVER (PARTITION BY d.symbol ORDER BY ts DESC) = 1""",
)
def lateral_latest(t):
    """Newest stored RSI of every symbol of the dimension."""
    stored = I.rsi_ewm(t.minutes().select("symbol", "open_time", "close"))
    last = latest_by_key(stored, ["symbol"], ["open_time"])
    return (
        t.event_dim().join(last, "symbol")
        .select(F.col("base_asset").alias("coin"), F.round("rsi_14", 6).alias("rsi_14"))
        .orderBy(F.desc("rsi_14"))
    )


@query(
    "warmup_context",
    V.with_views("minutes")
    + """SELECT symbol, open_time, close, is_context FROM (
        SELECT symbol, open_time, close, true AS is_context FROM minutes WHERE open_time < TIMESTAMP '2024-01-20'
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 120
        UNION ALL SELECT symbol, open_time, close, false FROM minutes WHERE open_time >= TIMESTAMP '2024-01-20')""",
)
def warmup_context(t):
    """New rows preceded by the last 120 rows of each symbol's history."""
    rows = t.minutes().select("symbol", "open_time", "close")
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return L.with_warmup(
        rows.where(F.col("open_time") < cut), rows.where(F.col("open_time") >= cut), ["symbol"], "open_time"
    )


@query(
    "momentum_warmup",
    V.with_views(
        "minutes", recursive=True,
        h="""SELECT * FROM minutes WHERE open_time < TIMESTAMP '2024-01-20'
            QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 120
            UNION ALL SELECT * FROM minutes WHERE open_time >= TIMESTAMP '2024-01-20'""",
        **_momentum("h", "open_time"),
    )
    + f"""SELECT symbol, ts AS open_time, round({V.RSI_OF_MEANS}, 6) AS rsi_14, round(e12 - e26, 6) AS macd FROM r
        WHERE ts >= TIMESTAMP '2024-01-20'""",
)
def momentum_warmup(t):
    """Indicators of new rows from 120 rows of context."""
    rows = t.minutes().select("symbol", "open_time", "close")
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp")
    out = I.momentum_after_warmup(rows.where(F.col("open_time") < cut), rows.where(F.col("open_time") >= cut))
    return out.select("symbol", "open_time", *[F.round(c, 6).alias(c) for c in ("rsi_14", "macd")])


C4 = V.candles("ticks", "open_time", V.bucket("open_time", 14400))


@query(
    "rsi_sma",
    V.with_views("ticks", c=C4, **V.rsi_sma_ctes("c")) + "SELECT symbol, ts, close, round(rsi, 6) AS rsi FROM s",
)
def rsi_sma(t):
    out = I.rsi_sma(C.candles(t.ticks(), 4 * 3600))
    return out.select("symbol", "ts", "close", F.round("rsi", 6).alias("rsi"))


def _heatmap_sql(seconds: int, zone: str = "") -> str:
    """Newest RSI pair of every trading symbol over 80 bars; `zone` adds a condition on the zone."""
    return V.with_views(
        "ticks", "event_dim", "event_ticker",
        c=V.candles("ticks", "open_time", V.bucket("open_time", seconds),
                    where=f"WHERE open_time >= (SELECT max(open_time) FROM ticks) - INTERVAL {seconds * 80 // 3600} HOUR"),
        **V.rsi_sma_ctes("c"),
        p="""SELECT *, lag(rsi) OVER (PARTITION BY symbol ORDER BY ts) AS prev,
            row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rn FROM s""",
        v="""SELECT symbol, arg_max(quote_volume_24h, snapshot_time) AS quote_volume_24h,
            arg_max(price_change_pct, snapshot_time) AS price_change_pct FROM event_ticker GROUP BY 1""",
    ) + f"""SELECT p.symbol, base_asset, round(rsi, 2) AS rsi, round(prev, 2) AS prev_rsi, round(rsi - prev, 2) AS rsi_delta,
        {V.ZONE.format('rsi')} AS zone, quote_volume_24h, round(price_change_pct, 6) AS price_change_pct,
        close AS latest_close, strftime(ts, '%Y-%m-%d %H:%M:%S') AS latest_time
        FROM p JOIN event_dim d ON d.symbol = p.symbol JOIN v ON v.symbol = p.symbol
        WHERE rn = 1 AND status = 'TRADING' AND rsi IS NOT NULL AND prev IS NOT NULL
          AND quote_volume_24h > 0 {zone}"""


def _heatmap(t, tf: str, zone: str):
    out = rsi_heatmap(t.ticks(), t.event_ticker(), t.event_dim(), tf, zone)
    return out.withColumn("price_change_pct", F.round("price_change_pct", 6))


@query("rsi_heatmap", _heatmap_sql(14400))
def heatmap(t):
    """4-hour bars, every zone; signups have no status and errors are delisted, so neither is shown."""
    return _heatmap(t, "4h", "All")


@query("rsi_heatmap_1h", _heatmap_sql(3600))
def heatmap_1h(t):
    return _heatmap(t, "1h", "All")


@query("rsi_heatmap_neutral", _heatmap_sql(14400, f"AND {V.ZONE.format('rsi')} = 'Neutral'"))
def heatmap_neutral(t):
    """One zone only."""
    return _heatmap(t, "4h", "Neutral")


@query(
    "rsi_zones",
    V.with_views("ticks", c=C4, **V.rsi_sma_ctes("c"))
    + f"SELECT {V.ZONE.format('rsi')} AS zone, count(*) AS n FROM s WHERE rsi IS NOT NULL GROUP BY 1",
)
def rsi_zones(t):
    """How many 4-hour bars fall in each zone."""
    bars = I.rsi_sma(C.candles(t.ticks(), 4 * 3600)).where(F.col("rsi").isNotNull())
    return bars.groupBy(rsi_zone(F.col("rsi")).alias("zone")).agg(F.count(F.lit(1)).alias("n"))


SIGNALS_SQL = f"""SELECT symbol, ts,
    CASE WHEN rsi > 70 THEN 'OVERBOUGHT (' || format('{{:.1f}}', rsi) || CASE WHEN rsi > rsi0 THEN ', rising)' ELSE ', falling)' END
         WHEN rsi < 30 THEN 'OVERSOLD (' || format('{{:.1f}}', rsi) || CASE WHEN rsi < rsi0 THEN ', falling)' ELSE ', rising)' END
         ELSE 'NEUTRAL (' || format('{{:.1f}}', rsi) || CASE WHEN rsi > rsi0 THEN ', rising)' ELSE ', falling)' END END AS rsi,
    CASE WHEN macd > 0 THEN 'BULLISH (' ELSE 'BEARISH (' END || format('{{:.2f}}', macd) ||
        CASE WHEN macd > 0 AND macd > macd0 THEN ', rising)' WHEN macd > 0 THEN ', falling)'
             WHEN macd < 0 AND macd < macd0 THEN ', falling)' ELSE ', rising)' END AS macd,
    CASE WHEN v_avg > 0 THEN CASE WHEN volume / v_avg > 1 THEN 'ABOVE' ELSE 'BELOW' END || ' average (' ||
        format('{{:.1f}}', volume / v_avg) || 'x)' ELSE 'NO DATA' END AS volume,
    CASE WHEN rise >= 0 THEN 'HIGHER HIGHS (bullish structure)' WHEN sink <= 0 THEN 'LOWER LOWS (bearish structure)'
        ELSE 'MIXED (no clear trend structure)' END AS structure
    FROM (SELECT *, min(up) OVER w4 AS rise, max(down) OVER w4 AS sink FROM (
        SELECT *, lag(rsi) OVER w AS rsi0, lag(macd) OVER w AS macd0, high - lag(high) OVER w AS up, low - lag(low) OVER w AS down,
            avg(volume) OVER (PARTITION BY symbol) AS v_avg, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS back
        FROM (SELECT c.*, {V.RSI_OF_MEANS} AS rsi, e12 - e26 AS macd FROM c JOIN r ON r.symbol = c.symbol AND r.ts = c.ts)
        WINDOW w AS (PARTITION BY symbol ORDER BY ts))
        WINDOW w4 AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
    WHERE back = 1"""


@query("signals", INDICATED + SIGNALS_SQL)
def signals_q(t):
    return signals(_medium(t))


@query(
    "close_series",
    V.with_views("ticks")
    + """SELECT symbol, open_time + INTERVAL 7 HOUR AS time, close AS price FROM ticks
        WHERE open_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-19'""",
)
def close_series(t):
    """Closes of a date range in the local zone."""
    from tickloom.operators.forecast import local_series

    return local_series(t.ticks(), "open_time", "close", "price", *CHART)


@query(
    "week_buckets",
    V.with_views("ticks")
    + f"""SELECT symbol, date_trunc('day', open_time) - to_days(CAST(dayofweek(open_time) AS INTEGER)) AS week_sunday,
        {V.bucket('open_time', 604800)} AS week_epoch, count(*) AS n FROM ticks GROUP BY 1, 2, 3""",
)
def week_buckets(t):
    """Calendar weeks start on Sunday, 604800-second buckets on Thursday."""
    ts = F.col("open_time")
    return (
        t.ticks()
        .groupBy("symbol", times.bucket(ts, "week").alias("week_sunday"), times.bucket(ts, 604800).alias("week_epoch"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "oldest_candles",
    V.with_views("minutes")
    + """SELECT symbol, open_time, close FROM minutes
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time) <= 120""",
)
def oldest_candles(t):
    """First 120 candles of every symbol."""
    return oldest_n(t.minutes().select("symbol", "open_time", "close"), ["symbol"], ["open_time"], 120)
