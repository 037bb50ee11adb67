"""Order-book metrics, views and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.times import local_time
from tickloom.operators import orderbook as O
from tickloom.operators import reports as R
from tickloom.plans import sqlviews as V
from tickloom.plans.registry import query
from tickloom.plans.tables import BOOK_DEPTH
from tickloom.presets import timeframe
from tickloom.sources.messages import parse_depth_json

RATIOS = ("spread_pct", "obi", "bid_ask_ratio")
PLAIN = [
    "symbol", "timestamp", "best_bid", "best_ask", "mid_price", "depth_bid_volume", "depth_ask_volume",
    "nearest_bid_wall_price", "nearest_bid_wall_volume", "nearest_ask_wall_price", "nearest_ask_wall_volume",
]
ALL_SQL = ", ".join(PLAIN) + ", " + ", ".join(f"round({c}, 6) AS {c}" for c in RATIOS)


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in RATIOS})


@query("order_book_metrics", V.with_views("books") + f"SELECT {ALL_SQL} FROM books")
def order_book_metrics(t):
    """Metrics of every supplier's monthly book; one-sided books keep a NULL row."""
    return _rounded(t.books())


@query(
    "depth_messages",
    V.with_views("ranked_levels")
    + """SELECT symbol, timestamp, count(*) FILTER (WHERE side = 'bid') AS n_bids, count(*) FILTER (WHERE side = 'ask') AS n_asks,
        max(price) FILTER (WHERE side = 'bid') AS best_bid, min(price) FILTER (WHERE side = 'ask') AS best_ask
        FROM ranked_levels GROUP BY 1, 2""",
)
def depth_messages(t):
    """Books through their JSON wire form and back."""
    wire = t.raw_books().select("symbol", "timestamp", F.to_json(F.struct(*(O.wire_levels(F.col(c)).alias(c) for c in ("bids", "asks")))).alias("body"))
    book = parse_depth_json(wire, "body")
    return book.select(
        "symbol",
        "timestamp",
        F.size("bids").cast("bigint").alias("n_bids"),
        F.size("asks").cast("bigint").alias("n_asks"),
        F.expr("try_cast(get(get(bids, 0), 0) AS double)").alias("best_bid"),
        F.expr("try_cast(get(get(asks, 0), 0) AS double)").alias("best_ask"),
    )


ZEROED = ", ".join(
    f"coalesce({c}, 0) AS {c}" for c in PLAIN if c not in ("symbol", "timestamp")
) + ", " + ", ".join(f"round(coalesce({c}, 0), 6) AS {c}" for c in RATIOS)


@query("ob_latest", V.with_views("last_book") + f"SELECT symbol, timestamp, {ZEROED} FROM last_book")
def ob_latest(t):
    return _rounded(O.ob_latest(t.latest_books()))


@query(
    "ob_summary_30d",
    V.with_views("books")
    + """SELECT symbol, round(avg(obi), 6) AS avg_obi, round(min(obi), 6) AS min_obi, round(max(obi), 6) AS max_obi,
        round(arg_max(obi, timestamp), 6) AS latest_obi FROM books
        WHERE timestamp >= (SELECT max(timestamp) FROM books) - INTERVAL 30 DAY GROUP BY 1""",
)
def ob_summary_30d(t):
    out = O.ob_summary(t.books(), as_of=t.books_as_of())
    return out.select("symbol", *[F.round(c, 6).alias(c) for c in out.columns if c != "symbol"])


TREND = f"""SELECT symbol, date_trunc('month', timestamp) AS ts, round(avg(obi), 6) AS avg_obi,
    round(avg(depth_bid_volume), 6) AS avg_bid_vol, round(avg(depth_ask_volume), 6) AS avg_ask_vol FROM books
    WHERE timestamp >= (SELECT max(timestamp) FROM books) - INTERVAL 730 DAY GROUP BY 1, 2"""


@query("ob_trend", V.with_views("books") + TREND)
def ob_trend(t):
    out = O.ob_trend(t.books(), "month", 730, t.books_as_of())
    return out.select("symbol", "ts", *[F.round(c, 6).alias(c) for c in ("avg_obi", "avg_bid_vol", "avg_ask_vol")])


@query(
    "obi_tag",
    V.with_views("books")
    + f"SELECT symbol, timestamp, {V.TAG.format('obi')} AS tag FROM books WHERE obi IS NOT NULL",
)
def obi_tag(t):
    return O.tagged(t.books().where(F.col("obi").isNotNull())).select("symbol", "timestamp", "tag")


@query(
    "imbalance_series",
    V.with_views("books")
    + "SELECT symbol, timestamp + INTERVAL 7 HOUR AS time, round((obi + 1) / 2, 6) AS imbalance FROM books WHERE obi IS NOT NULL",
)
def imbalance_series(t):
    """Older 0..1 imbalance in local time."""
    known = t.books().where(F.col("obi").isNotNull())
    return known.select(
        "symbol",
        local_time(F.col("timestamp"), "Asia/Ho_Chi_Minh").alias("time"),
        F.round(O.legacy_imbalance(F.col("obi")), 6).alias("imbalance"),
    )


@query(
    "depth_imbalance",
    V.with_views("levels")
    + """SELECT symbol, timestamp, round(sum(qty) FILTER (WHERE side = 'bid') / sum(qty), 6) AS imbalance FROM levels
        GROUP BY 1, 2 HAVING count(DISTINCT side) = 2""",
)
def depth_imbalance(t):
    """Imbalance over all levels of a book, whatever their distance from the middle."""
    return O.depth_imbalance(t.raw_books()).withColumn("imbalance", F.round("imbalance", 6))


def _trend_sql(unit: str, days: int) -> str:
    return V.with_views("books") + f"""SELECT symbol, date_trunc('{unit}', timestamp) AS ts, round(avg(obi), 6) AS avg_obi,
        round(avg(depth_bid_volume), 6) AS avg_bid_vol, round(avg(depth_ask_volume), 6) AS avg_ask_vol FROM books
        WHERE timestamp >= (SELECT max(timestamp) FROM books) - INTERVAL {days} DAY GROUP BY 1, 2"""


def _view(t, preset: str):
    """The book view of a preset, numbers rounded."""
    whole = timeframe(preset).book_mode == "latest_only"
    out = O.ob_view(t.latest_books() if whole else t.books(), timeframe(preset), None if whole else t.books_as_of())
    return out.select(*[F.round(c, 6).alias(c) if kind == "double" else c for c, kind in out.dtypes])


@query("ob_view_short", _trend_sql("hour", 3))
def ob_view_short(t):
    return _view(t, "short")


@query("ob_view_medium", _trend_sql("day", 30))
def ob_view_medium(t):
    return _view(t, "medium")


@query(
    "ob_view_long",
    V.with_views("books")
    + """SELECT symbol, round(avg(obi), 6) AS avg_obi, round(min(obi), 6) AS min_obi, round(max(obi), 6) AS max_obi,
        round(arg_max(obi, timestamp), 6) AS latest_obi FROM books
        WHERE timestamp >= (SELECT max(timestamp) FROM books) - INTERVAL 30 DAY GROUP BY 1""",
)
def ob_view_long(t):
    return _view(t, "long")


@query(
    "ob_view_very_long",
    V.with_views("last_book")
    + "SELECT symbol, timestamp, " + ", ".join(f"round(coalesce({c}, 0), 6) AS {c}" for c in [*PLAIN[2:], *RATIOS]) + " FROM last_book",
)
def ob_view_very_long(t):
    return _view(t, "very_long")


def _num(column: str, digits: int) -> str:
    return f"regexp_replace(format('{{:.6f}}', round({column}, {digits})), '\\.?0+$', '')"


@query(
    "liquidity_table",
    V.with_views("last_book")
    + f"""SELECT symbol, unnest(['Last updated', 'OBI ±0.5%', 'Bid Volume', 'Ask Volume', 'Bid/Ask Ratio', 'Spread',
            'Nearest Bid Wall', 'Bid Wall Vol', 'Nearest Ask Wall', 'Ask Wall Vol']) AS metric,
        unnest([strftime(timestamp + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S'), {_num('obi', 3)}, {_num('depth_bid_volume', 2)},
            {_num('depth_ask_volume', 2)}, {_num('bid_ask_ratio', 2)} || 'x', {_num('spread_pct', 4)} || '%',
            '$' || {_num('nearest_bid_wall_price', 2)}, {_num('nearest_bid_wall_volume', 2)},
            '$' || {_num('nearest_ask_wall_price', 2)}, {_num('nearest_ask_wall_volume', 2)}]) AS value FROM last_book""",
)
def liquidity_table(t):
    return O.liquidity_table(t.latest_books())


def _signed(x: str, digits: int = 3) -> str:
    text = f"format('{{:.{digits}f}}', coalesce({x}, 0))"
    return f"CASE WHEN {text} LIKE '-%' THEN {text} ELSE '+' || {text} END"


def _tagged(x: str) -> str:
    return f"{_signed(x)} || ' (' || {V.TAG.format(f'coalesce({x}, 0)')} || ')'"


BOOK_REPORT = f"""'Live Liquidity Pressure:' || chr(10) || '  OBI (±0.5% depth): ' || {_tagged('obi')} || chr(10)
    || '  Bid Volume: ' || format('{{:,.2f}}', coalesce(depth_bid_volume, 0)) || ' / Ask Volume: '
    || format('{{:,.2f}}', coalesce(depth_ask_volume, 0)) || chr(10) || '  Bid/Ask Ratio: '
    || format('{{:.2f}}', coalesce(bid_ask_ratio, 0)) || 'x' || chr(10) || '  Spread: '
    || format('{{:.4f}}', coalesce(spread_pct, 0)) || '%' AS report"""


@query("report_book_latest", V.with_views("last_book") + f"SELECT symbol, {BOOK_REPORT} FROM last_book")
def report_book_latest(t):
    return R.report_book(t.latest_books(), timeframe("very_long"))


SUMMARY = """SELECT symbol, avg(obi) AS a, min(obi) AS lo, max(obi) AS hi, arg_max(obi, timestamp) AS l FROM books
    WHERE timestamp >= (SELECT max(timestamp) FROM books) - INTERVAL 30 DAY GROUP BY 1"""
SUMMARY_REPORT = f"""'30-day order book summary:' || chr(10) || '  Avg OBI: ' || {_signed('a')} || chr(10) || '  Min: '
    || {_signed('lo')} || ' / Max: ' || {_signed('hi')} || chr(10) || '  Latest: ' || {_tagged('l')} AS report"""


@query("report_book_summary", V.with_views("books", s=SUMMARY) + f"SELECT symbol, {SUMMARY_REPORT} FROM s")
def report_book_summary(t):
    return R.report_book(t.books(), timeframe("long"), t.books_as_of())


TREND_VIEWS = {
    "d": """SELECT symbol, date_trunc('day', timestamp) AS ts, avg(obi) AS o, avg(depth_bid_volume) AS b,
        avg(depth_ask_volume) AS a FROM books
        WHERE timestamp >= (SELECT max(timestamp) FROM books) - INTERVAL 30 DAY GROUP BY 1, 2""",
    "x": f"""SELECT symbol, string_agg('  ' || strftime(ts, '%Y-%m-%d %H:00') || ' OBI:' || {_signed('o')} || ' Bid:'
        || format('{{:,.0f}}', coalesce(b, 0)) || ' Ask:' || format('{{:,.0f}}', coalesce(a, 0)), chr(10) ORDER BY ts) AS trend
        FROM d GROUP BY 1""",
}
TREND_REPORT = f"'Current OBI: ' || {_tagged('obi')} || coalesce(chr(10) || 'Order book trend:' || chr(10) || trend, '') AS report"


@query("report_book", V.with_views("last_book", **TREND_VIEWS) + f"SELECT l.symbol, {TREND_REPORT} FROM last_book l LEFT JOIN x ON x.symbol = l.symbol")
def report_book(t):
    """Trend mode of the medium preset."""
    return R.report_book(t.books(), timeframe("medium"), t.books_as_of(), t.latest_books())


def _listed(t):
    """Symbols with books, and some without (the regions)."""
    suppliers = t.read("supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"))
    return suppliers.unionByName(t.read("region").select(F.col("r_name").alias("symbol")))


LISTED = "(SELECT 'S' || s_suppkey AS symbol FROM supplier UNION SELECT r_name FROM region) n"


@query(
    "report_book_all",
    V.with_views("last_book", **TREND_VIEWS)
    + f"SELECT n.symbol, {TREND_REPORT} FROM {LISTED} LEFT JOIN last_book l ON l.symbol = n.symbol LEFT JOIN x ON x.symbol = n.symbol",
)
def report_book_all(t):
    """The same for a dimension that also lists symbols without books."""
    return R.report_book(t.books(), timeframe("medium"), t.books_as_of(), t.latest_books(), _listed(t))


@query(
    "report_book_summary_all",
    V.with_views("books", s=SUMMARY) + f"SELECT n.symbol, {SUMMARY_REPORT} FROM {LISTED} LEFT JOIN s ON s.symbol = n.symbol",
)
def report_book_summary_all(t):
    """Summary mode of the long preset for the same dimension."""
    return R.report_book(t.books(), timeframe("long"), t.books_as_of(), dim=_listed(t))


@query(
    "book_walls",
    V.with_views("books")
    + """SELECT count(nearest_bid_wall_price) AS bid_walls, count(nearest_ask_wall_price) AS ask_walls,
        count(*) FILTER (WHERE mid_price IS NULL) AS one_sided, count(*) AS n FROM books""",
)
def book_walls(t):
    """How many books show walls or miss a side."""
    return O.order_book_metrics(t.raw_books(), BOOK_DEPTH).agg(
        F.count("nearest_bid_wall_price").alias("bid_walls"),
        F.count("nearest_ask_wall_price").alias("ask_walls"),
        F.count_if(F.col("mid_price").isNull()).alias("one_sided"),
        F.count(F.lit(1)).alias("n"),
    )
