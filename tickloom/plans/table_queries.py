"""Stored tables that are kept up: upserted streams, buckets, roll-ups, audits, set-aside rows, table functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tickloom.functions.tables import register_book_tool, register_candle_tool, register_news_tool, register_ticker_tool
from tickloom.functions.times import instant
from tickloom.operators import load as L
from tickloom.operators.intervals import interval_join
from tickloom.operators.rollup import Pyramid
from tickloom.plans import book_queries as BQ
from tickloom.plans import candle_queries as CQ
from tickloom.plans import sqlviews as V
from tickloom.plans import text_queries as TQ
from tickloom.plans.registry import query
from tickloom.session import remove_path, work_path
from tickloom.sources.bucketed import latest_bucketed, write_bucketed
from tickloom.sources.candles import judged_klines
from tickloom.sources.messages import judged_depth, read_set_aside, read_stored, store_judged
from tickloom.sources.newsindex import append_index, newest_from_index, read_index
from tickloom.streaming.sinks import read_new_files, run_batches
from tickloom.streaming.tables import LateGuard, MonthlyUpsert
from tickloom.vocab import NO_NEWS, RAW_CANDLE_COLUMNS


def _delivered(t, parts, schema, handler, root: str) -> None:
    """The parts arrive as files one after the other; each arrival is a run of the stream."""
    for part in parts:
        part.write.mode("append").parquet(f"{root}/in")
        run_batches(read_new_files(t.spark, f"{root}/in", schema), handler, f"{root}/state")
    for path in (f"{root}/in", f"{root}/state"):
        remove_path(t.spark, path)


@query(
    "stream_upsert",
    V.with_views("ticker")
    + "SELECT symbol, snapshot_time, strftime(snapshot_time, '%Y-%m') AS month, quote_volume_24h, ingest FROM ticker",
)
def stream_upsert(t):
    """Deliveries out of order, some of them twice: the last one per symbol and time stands in the monthly table."""
    rows = t.raw_ticker().select(
        "symbol", "snapshot_time", "quote_volume_24h", "ingest", F.date_format("snapshot_time", "yyyy-MM").alias("month")
    )
    root = work_path(t.spark, "stream-upsert")
    handler = MonthlyUpsert(t.spark, f"{root}/table", rows.schema, ["symbol", "snapshot_time"], ["ingest"])
    dealt = F.col("ingest") % 3
    _delivered(t, [rows.where(dealt == 2), rows.where(dealt <= 1)], rows.schema, handler, root)
    return handler.rows()



@query(
    "stream_late",
    """WITH p AS (SELECT event_id, event_type, ts, value, CASE WHEN ts < TIMESTAMP '2024-01-12' AND event_id % 7 <> 3 THEN 0
            WHEN ts < TIMESTAMP '2024-01-22' AND event_id % 11 <> 5 THEN 1 ELSE 2 END AS part FROM events),
        m AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM p GROUP BY 1)
        SELECT event_id, event_type, ts, value, CASE WHEN ts < mark - INTERVAL 2 DAY THEN 'behind mark' ELSE 'stored' END AS reason
        FROM p JOIN m ON m.part = p.part""",
)
def stream_late(t):
    """Three deliveries; rows more than two days behind what came before are set aside, so stored and set aside are all."""
    rows = t.read("events").select("event_id", "event_type", "ts", "value")
    at = lambda day: F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    part = F.when((F.col("ts") < at("2024-01-12")) & (F.col("event_id") % 7 != 3), 0).when(
        (F.col("ts") < at("2024-01-22")) & (F.col("event_id") % 11 != 5), 1
    ).otherwise(2)
    root = work_path(t.spark, "stream-late")
    guard = LateGuard(t.spark, f"{root}/table", rows.schema, "ts", 2 * 86400)
    _delivered(t, [rows.where(part == k) for k in range(3)], rows.schema, guard, root)
    return guard.outcomes().drop("batch")


@query("latest_bucketed", V.with_views("ticker") + "SELECT symbol, snapshot_time, quote_volume_24h, trade_count, ingest FROM ticker")
def latest_bucketed_q(t):
    """Last delivery per symbol and time from a bucketed table; its plan has no exchange."""
    rows = t.raw_ticker().select("symbol", "snapshot_time", "quote_volume_24h", "trade_count", "ingest")
    path = work_path(t.spark, "bucketed")
    name = "ticker_" + path.rsplit("-", 1)[1]
    write_bucketed(rows, name, path, ["symbol", "snapshot_time"], ["ingest"])
    return latest_bucketed(t.spark, name, ["symbol", "snapshot_time"], ["ingest"])


#: Bucket widths that charts pick.
WIDTHS = (60, 300, 900, 3600, 14400, 43200, 86400, 604800)
SPAN = (dt.datetime(2024, 1, 5, 7, 31), dt.datetime(2024, 1, 23, 18, 2))


def _pyramid(t) -> Pyramid:
    """Minute candles in two loads; the second brings late ones, and is repeated."""
    pyramid = Pyramid(t.spark, work_path(t.spark, "pyramid"))
    rows = t.minutes()
    late = F.unix_seconds(instant(F.col("open_time"))) / 60 % 5 == 0
    pyramid.add(rows.where(~late), "first")
    for _ in range(2):
        pyramid.add(rows.where(late), "second")
    return pyramid


def _widths(where: str) -> str:
    one = "SELECT {0} AS width, symbol, {1} AS ts, arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, open_time) AS close, sum(volume) AS volume FROM (SELECT *, open_time AS t FROM minutes) {2} GROUP BY 2, 3"
    return V.with_views("minutes") + " UNION ALL ".join(one.format(w, V.bucket("t", w), where) for w in WIDTHS)


def _all_widths(pyramid, *span):
    parts = [pyramid.candles(w, *span).select(F.lit(w).alias("width"), "symbol", "ts", "open", "high", "low", "close", "volume") for w in WIDTHS]
    return L.union_evolving(*parts)


@query("candles_from_rollup", _widths(""))
def candles_from_rollup(t):
    """All bucket widths from stored minute, hour and day states."""
    return _all_widths(_pyramid(t))


@query("candles_from_rollup_range", _widths(f"WHERE t BETWEEN TIMESTAMP '{SPAN[0]}' AND TIMESTAMP '{SPAN[1]}'"))
def candles_from_rollup_range(t):
    """The same for a range whose ends lie inside hours and days."""
    return _all_widths(_pyramid(t), *SPAN)


@query(
    "forecast_bars",
    V.with_views("ticks", "minutes")
    + """SELECT f.event_id, count(*) AS n, min(m.low) AS low, max(m.high) AS high, arg_max(m.close, m.open_time) AS close
        FROM ticks f JOIN minutes m ON m.symbol = f.symbol AND m.open_time BETWEEN f.open_time AND f.open_time + INTERVAL 1 HOUR GROUP BY 1""",
)
def forecast_bars(t):
    """Every forecast with all minute candles of the hour it speaks of."""
    made = t.ticks().select("symbol", "event_id", F.col("open_time").alias("predicted_at"), (F.col("open_time") + F.make_dt_interval(hours=F.lit(1))).alias("target_time"))
    bars = t.minutes().select("symbol", "open_time", "high", "low", "close")
    met = interval_join(bars, made, ["symbol"], "open_time", "predicted_at", "target_time", 3600)
    return met.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.max_by("close", "open_time").alias("close")
    )


@query(
    "audit_sketch",
    V.with_views("raw_ticker")
    + """SELECT coalesce(strftime(snapshot_time, '%Y'), 'all') AS year, count(*) AS n_rows, min(snapshot_time) AS first_ts, max(snapshot_time) AS last_ts,
        true AS near FROM raw_ticker GROUP BY ROLLUP (strftime(snapshot_time, '%Y'))""",
)
def audit_sketch(t):
    """Audits per month and load, stored, then merged by year and over all; distinct symbols are within 5 % of the truth."""
    rows = t.raw_ticker().withColumns({"month": F.date_format("snapshot_time", "yyyy-MM"), "load": F.col("ingest") % 4})
    path = work_path(t.spark, "audit")
    L.audit_parts(rows, "symbol", "snapshot_time", "month", "load").write.parquet(path)
    parts = t.spark.read.parquet(path).withColumn("year", F.left("month", F.lit(4)))
    merged = L.merged_audit(parts, "year").unionByName(L.merged_audit(parts).withColumn("year", F.lit("all")))
    exact = rows.groupBy(F.date_format("snapshot_time", "yyyy").alias("year")).agg(F.countDistinct("symbol").alias("exact"))
    exact = exact.unionByName(rows.agg(F.countDistinct("symbol").alias("exact")).withColumn("year", F.lit("all")))
    near = F.abs(F.col("n_symbols") - F.col("exact")) <= 0.05 * F.col("exact")
    return merged.join(exact, "year").select("year", "n_rows", "first_ts", "last_ts", near.alias("near"))


@query(
    "depth_set_aside",
    """SELECT CASE doc_id % 5 WHEN 0 THEN 'no message' WHEN 1 THEN 'unreadable' WHEN 2 THEN 'no book' ELSE 'stored' END AS reason,
        count(*) AS n, sum(doc_id) AS ids, sum(CASE WHEN doc_id % 5 IN (1, 2) THEN 1 ELSE 0 END) AS bodies,
        CAST(sum(CASE doc_id % 5 WHEN 3 THEN 1 WHEN 4 THEN 0 END) AS BIGINT) AS bids FROM documents GROUP BY 1""",
)
def depth_set_aside(t):
    """Depth messages that broke in five ways; stored and set aside are all that were sent."""
    kind, doc = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    body = (
        F.when(kind == 1, F.concat(F.lit('{"bids": [["'), F.col("text")))
        .when(kind == 2, F.concat(F.lit('{"lastUpdateId": '), doc, F.lit("}")))
        .when(kind == 3, F.concat(F.lit('{"bids": [["'), doc, F.lit('", "1.5"]], "asks": []}')))
        .when(kind == 4, F.lit('{"asks": [["7", "2"]]}'))
    )
    sent = t.read("documents").select(F.col("doc_id").alias("symbol"), F.lit("2024-01-01").alias("timestamp"), body.alias("body"))
    judged = judged_depth(sent, "body")
    path = work_path(t.spark, "depth-judged")
    store_judged(judged, path)
    stored = read_stored(t.spark, path, judged.schema).select("symbol", F.lit("stored").alias("reason"), F.lit(0).alias("body"), F.size("bids").alias("bids"))
    aside = read_set_aside(t.spark, path, judged.schema).select("symbol", "reason", F.col("body").isNotNull().cast("int").alias("body"), F.lit(None).cast("int").alias("bids"))
    return stored.unionByName(aside).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("symbol").alias("ids"), F.sum("body").alias("bodies"), F.sum("bids").alias("bids")
    )


@query(
    "kline_set_aside",
    V.with_views("ticks")
    + """SELECT CASE event_id % 10 WHEN 0 THEN 'no message' WHEN 1 THEN 'unreadable' WHEN 2 THEN 'empty page' WHEN 3 THEN 'bad candle' ELSE 'stored' END AS reason,
        symbol, count(*) AS n, CAST(sum(CASE WHEN event_id % 10 > 3 THEN epoch_us(open_time) // 1000 END) AS BIGINT) AS times FROM ticks GROUP BY 1, 2""",
)
def kline_set_aside(t):
    """Pages of one candle, some broken: what cannot be stored keeps a row with its reason."""
    millis = F.unix_millis(instant(F.col("open_time"))).cast("string")
    cells = [millis, *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")], *[F.lit("0")] * (len(RAW_CANDLE_COLUMNS) - 6)]
    page, kind = F.to_json(F.array(F.array(*cells))), F.col("event_id") % 10
    body = (
        F.when(kind == 1, F.substring(page, F.lit(1), F.length(page) - 3)).when(kind == 2, F.lit("[]"))
        .when(kind == 3, F.to_json(F.array(F.array(millis, F.col("open").cast("string"))))).when(kind > 3, page)
    )
    judged = judged_klines(t.ticks().select("symbol", body.alias("body")), "body")
    path = work_path(t.spark, "klines-judged")
    store_judged(judged, path)
    stored = read_stored(t.spark, path, judged.schema).select("symbol", F.lit("stored").alias("reason"), "open_time")
    aside = read_set_aside(t.spark, path, judged.schema).select("symbol", "reason", F.lit(None).cast("long").alias("open_time"))
    return stored.unionByName(aside).groupBy("reason", "symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("open_time").alias("times"))


@query("news_from_index", TQ.NEWS_REPORT + "SELECT symbol, article_id, title, published_at, rn AS rank FROM k")
def news_from_index(t):
    """The articles that the news report picks for every symbol, from the stored index; two loads, one of them repeated and overlapping."""
    path = work_path(t.spark, "news-index")
    articles = TQ._transformed(t)
    first = F.col("published_at") < F.lit("2024-01-01 08:00:00").cast("timestamp")
    again = F.col("published_at") >= F.lit("2024-01-01 07:00:00").cast("timestamp")
    append_index(articles.where(first), path, "a")
    for _ in range(2):
        append_index(articles.where(again), path, "b")
    newest = newest_from_index(read_index(t.spark, path), 3, t.news_as_of())
    return newest.select("symbol", "article_id", "title", "published_at", F.col("rank").cast("long").alias("rank"))


@query(
    "tool_candles",
    CQ.INDICATED.rstrip() + f""", i AS ({TQ.BARS}) SELECT symbol, string_agg({TQ.CANDLE_LINE}, chr(10) ORDER BY ts) AS report FROM i WHERE symbol = 'click' GROUP BY 1""",
)
def tool_candles(t):
    """A candle report asked for in SQL text alone."""
    register_candle_tool(t.spark, t.ticks())
    return t.spark.sql("SELECT symbol, report FROM tool_candles(wanted => :symbol, preset => :timeframe)", args={"symbol": "click", "timeframe": "medium"})


def _asked(t, tool: str, **presets: str):
    """One report after the other, each asked for in SQL text alone."""
    calls = " UNION ALL ".join(f"SELECT symbol, report FROM {tool}(wanted => '{s}', preset => '{p}')" for s, p in presets.items())
    return t.spark.sql(calls)


@query("tool_ticker", TQ.listed_ticker_sql("SELECT unnest(['click', 'EUROPE']) AS symbol"))
def tool_ticker(t):
    """Volume and liquidity of a symbol and of one that is not listed."""
    register_ticker_tool(t.spark, t.event_ticker(), t.event_dim())
    return _asked(t, "tool_ticker", click="medium", EUROPE="no such preset")


@query(
    "tool_book",
    V.with_views("last_book", **BQ.TREND_VIEWS, s=BQ.SUMMARY)
    + f"""SELECT n.symbol, {BQ.TREND_REPORT} FROM (SELECT 'S1' AS symbol) n LEFT JOIN last_book l ON l.symbol = n.symbol LEFT JOIN x ON x.symbol = n.symbol
        UNION ALL SELECT n.symbol, {BQ.BOOK_REPORT} FROM (SELECT unnest(['S2', 'EUROPE']) AS symbol) n LEFT JOIN last_book l ON l.symbol = n.symbol
        UNION ALL SELECT n.symbol, {BQ.SUMMARY_REPORT} FROM (SELECT unnest(['S3', 'ASIA']) AS symbol) n LEFT JOIN s ON s.symbol = n.symbol""",
)
def tool_book(t):
    """Order books in the three modes, of suppliers and of symbols that are not listed."""
    dim = t.read("supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"))
    register_book_tool(t.spark, t.books(), dim, as_of=t.books_as_of(), latest=t.latest_books())
    return _asked(t, "tool_book", S1="medium", S2="very_long", S3="long", EUROPE="very_long", ASIA="long")


@query(
    "tool_news",
    TQ.NEWS_REPORT + f"SELECT n.symbol, coalesce(report, '{NO_NEWS}') AS report FROM (SELECT unnest(['UNDUSDT', 'EUROPE']) AS symbol) n LEFT JOIN y ON y.symbol = n.symbol",
)
def tool_news(t):
    """Newest articles of a symbol and of one that is not listed."""
    dim = t.read("region").select(F.col("r_name").alias("symbol")).where("symbol <> 'EUROPE'").unionByName(t.spark.sql("SELECT 'UNDUSDT' AS symbol"))
    register_news_tool(t.spark, TQ._transformed(t), dim, as_of=t.news_as_of())
    return _asked(t, "tool_news", UNDUSDT="short", EUROPE="short")
