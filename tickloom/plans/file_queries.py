"""File sources and streams: the given tables are landed in the shared work folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.times import epoch_millis
from tickloom.operators.candles import candles
from tickloom.operators.news import news_dedup
from tickloom.plans import candle_queries as CQ
from tickloom.plans import sqlviews as V
from tickloom.plans.registry import query
from tickloom.session import remove_path, work_path
from tickloom.sources import lake, marked
from tickloom.sources.candles import parse_kline_json, scan_klines_csv
from tickloom.sources.messages import parse_ticker_json
from tickloom.streaming.candles import stream_candles, stream_dedup
from tickloom.streaming.indicators import MomentumStream
from tickloom.streaming.sinks import read_new_files, run_available, run_batches
from tickloom.vocab import RAW_CANDLE_COLUMNS


def wire_candles(t):
    """Ticks as raw candle rows; clicks carry µs epochs, all other symbols ms."""
    micros = F.unix_micros(F.col("open_time").cast("timestamp"))
    opened = F.when(F.col("symbol") == "click", micros).otherwise(F.floor(micros / 1000).cast("bigint"))
    half = F.col("volume") / 2
    return t.ticks().select(
        "symbol",
        opened.alias("open_time"),
        "open", "high", "low", "close", "volume",
        (opened + F.when(F.col("symbol") == "click", 59999999).otherwise(59999)).alias("close_time"),
        "quote_volume",
        F.lit(1).cast("bigint").alias("trade_count"),
        half.alias("taker_buy_base"),
        (half * F.col("close")).alias("taker_buy_quote"),
    )


WIRE_SQL = """epoch_us(open_time) // 1000 AS open_time, open, high, low, close, volume,
    CASE WHEN symbol = 'click' THEN (epoch_us(open_time) + 59999999) // 1000 ELSE epoch_us(open_time) // 1000 + 59999 END AS close_time,
    close * volume AS quote_volume, CAST(1 AS BIGINT) AS trade_count, volume / 2 AS taker_buy_base, volume / 2 * close AS taker_buy_quote"""


@query("scan_klines_csv", V.with_views("ticks") + f"SELECT symbol, {WIRE_SQL} FROM ticks")
def scan_klines_csv_q(t):
    """Bulk CSV files without header, one folder per symbol."""
    path = work_path(t.spark, "klines-csv")
    wire_candles(t).select("symbol", *RAW_CANDLE_COLUMNS, F.lit("0").alias("ignored")).write.partitionBy(
        "symbol"
    ).csv(path)
    return scan_klines_csv(t.spark, path)


@query("parse_kline_json", V.with_views("ticks") + f"SELECT symbol, {WIRE_SQL} FROM ticks")
def parse_kline_json_q(t):
    """REST pages: an array of 12-element arrays of text per message."""
    fields = [F.col(c).cast("string") for c in RAW_CANDLE_COLUMNS] + [F.lit("0")]
    pages = wire_candles(t).select("symbol", F.to_json(F.array(F.array(*fields))).alias("body"))
    out = parse_kline_json(pages, "body")
    return out.withColumns({c: epoch_millis(F.col(c)) for c in ("open_time", "close_time")})


SLIM = ["symbol", "open_time", "close", "volume"]


def _landed(t):
    """January as a base file and three deltas: two with a write time, one with a broken name."""
    root = work_path(t.spark, "lake")
    micros = F.unix_micros(F.col("open_time").cast("timestamp"))
    rows = t.ticks().select(*SLIM).withColumn("open_time", micros)
    cuts = ["2024-01-08", "2024-01-16", "2024-01-24"]
    at = [F.unix_micros(F.lit(c).cast("timestamp")) for c in cuts]
    ts = F.col("open_time")
    rows.where(ts < at[0]).write.option("header", "true").csv(f"{root}/base/2024-01.csv")
    rows.where((ts >= at[0]) & (ts < at[1])).write.parquet(f"{root}/delta/2024-01_delta_1000_ab12.parquet")
    # a later delta has a column the earlier ones lack
    later = rows.where((ts >= at[1]) & (ts < at[2])).withColumn("close2", F.col("close") * 2)
    later.write.parquet(f"{root}/delta/2024-01_delta_2000_cd34.parquet")
    rows.where(ts >= at[2]).write.parquet(f"{root}/delta/2024-01_delta_broken.parquet")
    return root


@query(
    "scan_base_delta",
    V.with_views("ticks")
    + """SELECT symbol, open_time, close, volume, CASE WHEN open_time >= TIMESTAMP '2024-01-16'
        AND open_time < TIMESTAMP '2024-01-24' THEN close * 2 END AS close2 FROM ticks""",
)
def scan_base_delta(t):
    """Full read: base CSV and every delta, new columns included."""
    root = _landed(t)
    rows = lake.scan_base_delta(
        t.spark,
        [f"{root}/delta"],
        base_csv=f"{root}/base/2024-01.csv",
        schema="symbol string, open_time bigint, close double, volume double, close2 double",
    )
    return rows.withColumn("open_time", F.timestamp_micros("open_time"))


@query(
    "incremental_files",
    V.with_views("ticks")
    + """SELECT symbol, open_time, close, volume FROM ticks
        WHERE open_time >= TIMESTAMP '2024-01-16' AND open_time < TIMESTAMP '2024-01-24'""",
)
def incremental_files(t):
    """Only the delta written after the last run; the broken name is skipped."""
    return lake.read_deltas(t.spark, [f"{_landed(t)}/delta"], since_ms=1500).select(*SLIM).withColumn(
        "open_time", F.timestamp_micros("open_time")
    )


@query(
    "discover_months",
    "SELECT DISTINCT strftime(ts, '%Y-%m') AS month FROM events",
)
def discover_months(t):
    """Months of file names made from every event; malformed names are ignored."""
    name = F.when(
        F.col("event_type") == "error", F.concat(F.lit("k/2024-13_delta_"), F.col("event_id").cast("string"), F.lit(".parquet"))
    ).otherwise(
        F.concat(F.lit("k/"), F.date_format("ts", "yyyy-MM"), F.lit("_delta_"), F.col("event_id").cast("string"), F.lit(".parquet"))
    )
    return lake.discover_months(t.read("events").select(name.alias("key")), "key")


@query(
    "upsert_months",
    V.with_views("ticker")
    + """SELECT symbol, snapshot_time, strftime(snapshot_time, '%Y-%m') AS month,
        CASE WHEN snapshot_time >= TIMESTAMP '2001-01-01' THEN quote_volume_24h * 2 ELSE quote_volume_24h END AS quote_volume_24h
        FROM ticker""",
)
def upsert_months(t):
    """A corrected year is merged into a monthly table on disk; a second run changes nothing."""
    path = work_path(t.spark, "ticker")
    rows = t.ticker().select(
        "symbol", "snapshot_time", "quote_volume_24h", F.date_format("snapshot_time", "yyyy-MM").alias("month")
    )
    rows.repartition("month", F.pmod(F.xxhash64("symbol"), F.lit(lake.FILES_PER_PARTITION))).write.partitionBy("month").parquet(path)
    late = rows.where(F.col("snapshot_time") >= F.lit("2001-01-01 00:00:00").cast("timestamp_ntz"))
    fixed = late.withColumn("quote_volume_24h", F.col("quote_volume_24h") * 2)
    months = [r["month"] for r in late.select("month").distinct().collect()]  # bounded by the calendar
    for _ in range(2):
        lake.upsert_months(fixed, path, ["symbol", "snapshot_time"], ["month"], months=months, schema=rows.schema)
    out = t.spark.read.schema(fixed.schema).parquet(path)
    return out.select("symbol", "snapshot_time", "month", "quote_volume_24h")


def _streamed(t, rows, name, transform):
    """Land a frame as files, run the streaming transformation over them and read what it stored; only that is left."""
    landed, out = work_path(t.spark, f"{name}-in"), work_path(t.spark, name)
    rows.write.parquet(landed)
    stream = transform(read_new_files(t.spark, landed, rows.schema))
    run_available(stream, f"{out}/rows", f"{out}/state")
    for path in (landed, f"{out}/state"):
        remove_path(t.spark, path)
    return t.spark.read.schema(stream.schema).parquet(f"{out}/rows")


@query(
    "stream_candles",
    V.with_views("ticks", c=V.candles("ticks", "open_time", "date_trunc('day', open_time)"))
    + f"SELECT {CQ.BARS} FROM c WHERE ts + INTERVAL 1 DAY <= (SELECT max(open_time) - INTERVAL 1 HOUR FROM ticks)",
)
def stream_candles_q(t):
    """Daily candles from a file stream; days the watermark has not passed are held back."""
    return _streamed(t, t.ticks(), "stream-candles", lambda s: stream_candles(s, "1 day", "1 hour"))


@query("stream_dedup", "SELECT event_id, event_type, ts, value FROM events")
def stream_dedup_q(t):
    """Every event delivered twice, stored once."""
    events = t.read("events").select("event_id", "event_type", "ts", "value")
    return _streamed(t, events.unionByName(events), "stream-dedup", lambda s: stream_dedup(s, ["event_id"], "ts", "1 hour"))


@query(
    "stream_ewm",
    V.with_views("minutes", recursive=True, **CQ._momentum("minutes", "open_time"))
    + f"""SELECT symbol, ts AS open_time, round({V.RSI_OF_MEANS}, 6) AS rsi_14, round(e12 - e26, 6) AS macd FROM r""",
)
def stream_ewm(t):
    """Three deliveries of minute candles, each continuing from the stored means."""
    spark, root = t.spark, work_path(t.spark, "stream-ewm")
    minutes = candles(t.ticks(), 60).select("symbol", F.col("ts").alias("open_time"), "close")
    handler = MomentumStream(spark, f"{root}/out")
    cuts = [F.lit(c).cast("timestamp") for c in ("1970-01-01", "2024-01-11", "2024-01-21", "9999-01-01")]
    for low, high in zip(cuts, cuts[1:]):
        part = minutes.where((F.col("open_time") >= low) & (F.col("open_time") < high))
        part.write.mode("append").parquet(f"{root}/in")
        run_batches(read_new_files(spark, f"{root}/in", minutes.schema), handler, f"{root}/state")
    for path in (f"{root}/in", f"{root}/state"):
        remove_path(spark, path)
    out = handler.rows()
    return out.select("symbol", "open_time", *[F.round(c, 6).alias(c) for c in ("rsi_14", "macd")])


def _loaded(t, name: str, parts, keys, ts: str, month):
    """The parts loaded one after the other into a table with marks, the last one twice, and read back."""
    path = work_path(t.spark, name)
    for rows in [*parts, parts[-1]]:
        marked.load_into(rows.withColumn("month", month), path, keys, ts)
    return marked.read_loaded(t.spark, path, parts[-1].withColumn("month", month).schema).drop("month")


@query("load_candles", V.with_views("minutes") + "SELECT symbol, open_time, close, volume FROM minutes")
def load_candles(t):
    """Minute candles: the first two weeks, then the whole table, then the whole table again."""
    rows = t.minutes().select("symbol", "open_time", "close", "volume")
    first = rows.where(F.col("open_time") < F.lit("2024-01-15 00:00:00").cast("timestamp"))
    return _loaded(t, "load-candles", [first, rows], ["symbol"], "open_time", F.date_format("open_time", "yyyy-MM"))


@query("load_ticker", V.with_views("ticker") + "SELECT symbol, snapshot_time, quote_volume_24h FROM ticker")
def load_ticker(t):
    rows = t.ticker().select("symbol", "snapshot_time", "quote_volume_24h")
    first = rows.where(F.col("snapshot_time") < F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"))
    return _loaded(t, "load-ticker", [first, rows], ["symbol"], "snapshot_time", F.date_format("snapshot_time", "yyyy-MM"))


@query(
    "load_news",
    V.with_views("news") + "SELECT article_id, published_at AS extracted_at, source_name FROM news",
)
def load_news(t):
    """Articles under one mark for the whole table."""
    rows = news_dedup(t.raw_news(), ["doc_id"]).select("article_id", "extracted_at", "source_name")
    first = rows.where(F.col("extracted_at") < F.lit("2024-01-01 06:00:00").cast("timestamp"))
    return _loaded(t, "load-news", [first, rows], [], "extracted_at", F.date_format("extracted_at", "yyyy-MM"))


@query(
    "ticker_increment",
    """SELECT 'C' || o_custkey AS symbol, max(o_orderkey) AS close_time, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1""",
)
def ticker_increment(t):
    """Snapshots by (symbol, source close time) through their wire form; a page sent twice adds nothing."""
    raw = t.read("orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"),
        F.to_json(F.array(F.struct(
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"),
            F.col("o_totalprice").cast("string").alias("bidPrice"), F.col("o_orderkey").cast("string").alias("closeTime"),
        ))).alias("body"),
    )
    wire = parse_ticker_json(raw, "body", ["closeTime"]).select("symbol", F.col("closeTime").cast("bigint").alias("close_time"), F.lit("all").alias("month"))
    path = work_path(t.spark, "ticker-increment")
    for part in (wire.where(F.col("close_time") < 3000), wire, wire):
        marked.load_into(part, path, ["symbol"], "close_time")
    marked.fold_loads(t.spark, path, wire.schema)
    stored = marked.read_loaded(t.spark, path, wire.schema)
    return stored.groupBy("symbol").agg(F.max("close_time").alias("close_time"), F.count("*").alias("n"))


@query(
    "delete_rewrite",
    """SELECT conv_id, turn, role FROM conversations WHERE NOT (role = 'system' OR conv_id % 10 = 3)""",
)
def delete_rewrite(t):
    """A stored table by last digit of the session, rewritten without system messages and one whole partition."""
    rows = t.read("conversations").select("conv_id", "turn", "role", (F.col("conv_id") % 10).cast("string").alias("month"))
    path = work_path(t.spark, "delete-rewrite")
    rows.write.partitionBy("month").parquet(path)
    gone = (F.col("role") == "system") | (F.col("month") == "3")
    for _ in range(2):
        lake.delete_from(t.spark, path, gone, rows.schema)
    return t.spark.read.schema(rows.schema).parquet(path).drop("month")
