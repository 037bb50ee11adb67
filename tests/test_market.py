"""Ticker, order book, labels and number formats."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions import numbers
from tickloom.functions.labels import in_zone, obi_tag, rsi_zone
from tickloom.operators import heatmap, orderbook, ticker
from tickloom.operators.latest import latest_by_key, latest_known, top_n
from tickloom.sources import lake, messages
from tickloom.vocab import DELISTED_ON, REGISTERED_SYMBOLS

WIRE = (
    "symbol string, priceChange string, priceChangePercent string, highPrice string, lowPrice string, "
    "volume string, quoteVolume string, count bigint, bidPrice string, askPrice string"
)
ROWS = [
    ("BTCUSDT", "1500.00", "3.50", "44000.00", "41000.00", "25000.50", "1050000000.00", 1200000, "42290.00", "42310.00"),
    ("ETHUSDT", "80.00", "2.80", "2900.00", "2750.00", "150000.20", "420000000.00", 800000, "2849.50", "2850.50"),
    ("DOGEUSDT", "0.005", "1.20", "0.42", "0.40", "5000000.00", "2050000.00", 300000, "0.4100", "0.4105"),
]
def now():
    return F.lit("2026-05-15 08:45:00").cast("timestamp")



def test_ticker_transform(spark):
    df = spark.createDataFrame(ROWS, WIRE)
    dim = spark.createDataFrame([("BTCUSDT",), ("ETHUSDT",)], "symbol string")
    out = ticker.ticker_transform(ticker.tracked(df, dim), now())
    assert out.columns == schemas.columns(schemas.TICKER)
    rows = {r["symbol"]: r for r in out.collect()}
    assert set(rows) == {"BTCUSDT", "ETHUSDT"}
    assert rows["BTCUSDT"]["spread_pct"] == pytest.approx(0.04727, abs=1e-5)
    assert str(rows["BTCUSDT"]["snapshot_time"]) == "2026-05-15 08:45:00"


@pytest.mark.parametrize("bid, ask, want", [("1", "0", 0.0), ("x", "2", 0.0), ("1", None, 0.0), ("1", "2", 50.0)])
def test_spread_of_bad_quotes(spark, bid, ask, want):
    df = spark.createDataFrame([("A", bid, ask)], "symbol string, bidPrice string, askPrice string")
    row = ticker.ticker_transform(df, now()).first()
    assert row["spread_pct"] == want and row["high_24h"] is None


def test_missing_quote_columns(spark):
    df = spark.createDataFrame([("A", "1")], "symbol string, bidPrice string")
    assert ticker.ticker_transform(df, now()).first()["spread_pct"] == 0.0


def book(spark, bids, asks):
    return spark.createDataFrame([("BTCUSDT", dt.datetime(2026, 5, 15, 8, 45), bids, asks)], schemas.RAW_BOOK)


def metrics(spark, bids, asks, **kw):
    return orderbook.order_book_metrics(book(spark, bids, asks), **kw).first()


def test_order_book_example(spark):
    m = metrics(spark, [["42290.00", "1.5"], ["42285.00", "2.3"]], [["42310.00", "1.2"], ["42315.00", "3.1"]])
    assert m["depth_bid_volume"] == pytest.approx(3.8) and m["depth_ask_volume"] == pytest.approx(4.3)
    assert m["obi"] == pytest.approx(-0.0617, abs=1e-4)
    assert m["spread_pct"] == pytest.approx(0.0473, abs=1e-4)
    assert m["bid_ask_ratio"] == pytest.approx(0.8837, abs=1e-4)
    assert m["nearest_bid_wall_price"] is None and m["nearest_ask_wall_volume"] is None


def test_wall_takes_the_first_of_equal_levels(spark):
    bids = [["100", "1"], ["99.9", "1"], ["99.8", "1"], ["99.7", "20"]]
    m = metrics(spark, bids, [["100.1", "1"]])
    assert (m["nearest_bid_wall_price"], m["nearest_bid_wall_volume"]) == (99.7, 20.0)
    many = [[str(100 - i / 100), "20" if i in (3, 5) else "0.1"] for i in range(20)]
    assert metrics(spark, many, [["100.1", "1"]])["nearest_bid_wall_price"] == 99.97


@pytest.mark.parametrize("bids, asks", [([], [["1", "1"]]), ([["1", "1"]], []), (None, [["1", "1"]]), ([], [])])
def test_empty_side_keeps_a_null_row(spark, bids, asks):
    row = metrics(spark, bids, asks).asDict()
    assert row.pop("symbol") == "BTCUSDT" and row.pop("timestamp")
    assert set(row.values()) == {None}


def test_depth_band_and_short_levels(spark):
    m = metrics(spark, [["100"], ["100", "2"], ["98", "50"]], [["100.2", "3"], ["102", "50"], ["100.3"]])
    assert (m["best_bid"], m["depth_bid_volume"], m["depth_ask_volume"]) == (100.0, 2.0, 3.0)
    far = metrics(spark, [["50", "1"]], [["150", "1"]])
    assert (far["depth_bid_volume"], far["obi"], far["bid_ask_ratio"]) == (0.0, 0.0, None)


def test_books_hold_every_level(spark):
    rows = [("S", dt.datetime(2024, 1, 1), side, float(p), 1.0) for side in ("bid", "ask") for p in range(1, 151)]
    rows += rows[:5]  # equal prices add up
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, side string, price double, qty double")
    row = orderbook.books_from_levels(df).first()
    assert len(row["bids"]) == len(row["asks"]) == 150
    assert tuple(row["bids"][0]) == (150.0, 1.0) and tuple(row["asks"][0]) == (1.0, 1.0) and tuple(row["bids"][-1]) == (1.0, 2.0)


def test_metrics_see_all_levels_near_the_middle(spark):
    """150 levels a side within half a percent all count, typed or as text."""
    rows = [("S", dt.datetime(2024, 1, 1), "bid", 100 - k / 1000, 1.0) for k in range(1, 151)]
    rows += [("S", dt.datetime(2024, 1, 1), "ask", 100 + k / 1000, 1.0) for k in range(1, 151)]
    books = orderbook.books_from_levels(
        spark.createDataFrame(rows, "symbol string, timestamp timestamp, side string, price double, qty double")
    )
    text = books.withColumns({c: orderbook.wire_levels(F.col(c)) for c in ("bids", "asks")})
    for df in (books, text):
        m = orderbook.order_book_metrics(df).first()
        assert (m["depth_bid_volume"], m["depth_ask_volume"], m["obi"]) == (150.0, 150.0, 0.0)


def test_depth_imbalance(spark):
    rows = [("S", dt.datetime(2024, 1, 1), "bid", 1.0, 3.0), ("S", dt.datetime(2024, 1, 1), "ask", 900.0, 1.0), ("T", dt.datetime(2024, 1, 1), "ask", 9.0, 1.0)]
    books = orderbook.books_from_levels(
        spark.createDataFrame(rows, "symbol string, timestamp timestamp, side string, price double, qty double")
    )
    assert [(r.symbol, r.imbalance) for r in orderbook.depth_imbalance(books).collect()] == [("S", 0.75)]


def test_report_ends_with_the_newest_bar(spark):
    """100 days of hourly rows: the medium preset's report closes with the last one."""
    from tickloom.operators.reports import market_report
    from tickloom.presets import timeframe

    start = dt.datetime(2024, 1, 1)
    rows = [("A", start + dt.timedelta(hours=h), *([100.0 + h] * 4), 1.0) for h in range(2400)]
    klines = spark.createDataFrame(rows, "symbol string, open_time timestamp, open double, high double, low double, close double, volume double")
    report = market_report(klines, timeframe("medium")).first()["report"]
    assert f"Latest close: {100.0 + 2399:.4f}" in report and "2024-04-09 20:00" in report


def test_depth_message(spark):
    df = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 1), '{"lastUpdateId": 1, "bids": [["1.0", "2"]]}')], "symbol string, timestamp timestamp, body string"
    )
    row = messages.parse_depth_json(df, "body").first()
    assert row["bids"] == [["1.0", "2"]] and row["asks"] == []


@pytest.mark.parametrize(
    "obi, want",
    [(0.30, "strong bid pressure"), (0.29, "mild bid pressure"), (0.10, "balanced"), (0.0, "balanced"),
     (-0.10, "balanced"), (-0.11, "mild ask pressure"), (-0.30, "strong ask pressure")],
)
def test_obi_tags(spark, obi, want):
    assert spark.range(1).select(obi_tag(F.lit(obi))).first()[0] == want


def test_zones(spark):
    values = [70.0, 69.9, 60.0, 59.9, 40.0, 39.9, 30.0, 29.9]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(rsi_zone(F.col("v")).alias("z")).collect()
    assert [r["z"] for r in got] == ["Overbought", "Strong", "Strong", "Neutral", "Neutral", "Weak", "Weak", "Oversold"]
    flags = spark.range(1).select(in_zone(F.lit("Weak"), "wEAK"), in_zone(F.lit("Weak"), "All"), in_zone(F.lit("Weak"), "Strong"))
    assert tuple(flags.first()) == (True, True, False)


@pytest.mark.parametrize("value", [0.125, 2.675, 1234567.5, -0.001, 0.0, 1.005, 99999.995, -12.345])
def test_fixed_equals_python_format(spark, value):
    row = spark.range(1).select(
        numbers.fixed(F.lit(value), 2), numbers.fixed(F.lit(value), 0, comma=True), numbers.fixed(F.lit(value), 3, plus=True)
    ).first()
    assert tuple(row) == (f"{value:.2f}", f"{value:,.0f}", f"{value:+.3f}")


@pytest.mark.parametrize(
    "value, usd, price",
    [(1.25e12, "$1.2T", None), (1.2e13, "$12T", None), (3.4e9, "$3.4B", None), (5.6e7, "$56M", None), (7499.0, "$7K", "$7,499"),
     (12.0, "$12", "$12.00"), (1234.5, "$1K", "$1,234.5"), (0.0123456, "$0", "$0.0123"), (0.00123456, "$0", "$0.001235"), (None, "-", "-")],
)
def test_compact_formats(spark, value, usd, price):
    x = F.lit(value).cast("double")
    row = spark.range(1).select(numbers.compact_usd(x), numbers.price_text(x)).first()
    assert row[0] == usd and (price is None or row[1] == price)


@pytest.mark.parametrize("value, want", [(1.0, "1"), (0.5, "0.5"), (100.0, "100"), (-0.25, "-0.25"), (0.0, "0")])
def test_shortest(spark, value, want):
    assert spark.range(1).select(numbers.shortest(F.lit(value))).first()[0] == want


def test_liquidity_table(spark):
    out = orderbook.liquidity_table(orderbook.order_book_metrics(book(spark, [["42290", "1.5"]], [["42310", "1"]])))
    cells = {r["metric"]: r["value"] for r in out.collect()}
    assert len(cells) == 10 and cells["Last updated"] == "2026-05-15 15:45:00"
    assert cells["Bid/Ask Ratio"] == "1.5x" and cells["OBI ±0.5%"] == "0.2" and cells["Spread"] == "0.0473%"


def test_latest_prefers_later_ingest_and_skips_null_values(spark):
    df = spark.createDataFrame([("A", 1, 1, 5.0), ("A", 1, 2, 6.0), ("A", 0, 9, 7.0), ("A", 2, 3, None)], "k string, t int, i int, v double")
    assert latest_by_key(df.where("t < 2"), ["k"], ["t", "i"]).first()["v"] == 6.0
    assert latest_by_key(df, ["k"], ["t"]).first()["v"] is None
    assert df.where("i <> 1").groupBy("k").agg(latest_known("v", "t").alias("v")).first()["v"] == 6.0


def test_latest_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS t")
    plan = latest_by_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in top_n(df, "t", 3, ["k"])._jdf.queryExecution().executedPlan().toString()


def test_heatmap_rules(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(s, start + dt.timedelta(hours=4 * i), 100.0 + (i * i) % 7, 100.0, 100.0, 100.0 + (i * 5) % 11) for s in "ABCD" for i in range(30)]
    k = spark.createDataFrame(rows, "symbol string, open_time timestamp, open double, high double, low double, close double")
    t = spark.createDataFrame([(s, start, v, 1.0) for s, v in (("A", 5.0), ("B", 0.0), ("C", 9.0), ("D", 3.0))], "symbol string, snapshot_time timestamp, quote_volume_24h double, price_change_pct double")
    d = spark.createDataFrame([("A", "a", "TRADING"), ("B", "b", "TRADING"), ("C", "c", "BREAK"), ("D", "d", None)], "symbol string, base_asset string, status string")
    assert [r["symbol"] for r in heatmap.rsi_heatmap(k, t, d).collect()] == ["A"]  # no volume, delisted, status unknown


def test_market_snapshot_keeps_unmatched_symbols(spark):
    dim = spark.createDataFrame([("A", "a"), ("B", "b")], "symbol string, base_asset string")
    k = spark.createDataFrame([("A", 1, 2.0), ("A", 2, 3.0)], "symbol string, open_time int, close double")
    t = spark.createDataFrame([("A", 1, 4.0)], "symbol string, snapshot_time int, price_change_pct double")
    rows = {r["symbol"]: tuple(r)[2:] for r in ticker.market_snapshot(dim, k, t).collect()}
    assert rows == {"A": (2, 3.0, 4.0), "B": (None, None, None)}


def test_registry(spark):
    rows = {r["symbol"]: r for r in lake.registry(spark).collect()}
    assert len(rows) == len(REGISTERED_SYMBOLS) == 50
    assert rows["BTCUSDT"]["base_asset"] == "BTC" and rows["BTCUSDT"]["quote_asset"] == "USDT"
    assert {s for s, r in rows.items() if r["status"] == "BREAK"} == set(DELISTED_ON)


def test_book_view_follows_the_preset(spark):
    from tickloom.presets import timeframe

    books = orderbook.order_book_metrics(book(spark, [["42290", "1.5"]], [["42310", "1"]]))
    views = {p: orderbook.ob_view(books, timeframe(p)).columns for p in ("short", "long", "very_long")}
    assert "ts" in views["short"] and "latest_obi" in views["long"] and "best_bid" in views["very_long"]


def test_unreadable_messages_are_found(spark):
    df = spark.createDataFrame([('[{"symbol": "A", "closeTime": 7}]',), ("[{",), (None,)], "body string")
    kept = messages.parse_ticker_json(df, "body", ["closeTime"]).collect()
    assert [(r.symbol, r.closeTime) for r in kept] == [("A", "7")]
    assert [r.body for r in messages.unreadable(df, "body", "array<struct<symbol: string>>").collect()] == ["[{"]


def test_negative_price(spark):
    x = F.lit(-1234.5)
    assert spark.range(1).select(numbers.price_text(x)).first()[0] == "-$1,234.5"
    assert spark.range(1).select(numbers.price_text(F.lit(-0.00123))).first()[0] == "-$0.001230"
