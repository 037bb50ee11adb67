"""Market tables as views over the given parquet tables.

Two markets are modelled. The *event market* has one symbol per event type and a tick per event.
The *account market* has one symbol per customer: candles from that user's events, ticker
snapshots from orders, the dimension from customers. Each view has a twin in SQL (plans/sqlviews.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.text import article_id
from tickloom.functions.times import newest
from tickloom.operators.candles import candles
from tickloom.operators.latest import at_latest, latest_by_key
from tickloom.operators.orderbook import books_from_levels, order_book_metrics
from tickloom.operators.ticker import spread_of_ask

BOOK_DEPTH = 0.5  # prices of the given tables spread far wider than a real ladder


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- event market -------------------------------------------------------
    def ticks(self) -> DataFrame:
        """One raw candle per event; event_id is the delivery order."""
        k = F.get_json_object("props", "$.k").try_cast("double")
        return self.read("events").select(
            F.col("event_type").alias("symbol"),
            F.col("ts").alias("open_time"),
            *[F.col("value").alias(c) for c in ("open", "high", "low", "close")],
            k.alias("volume"),
            (F.col("value") * k).alias("quote_volume"),
            "event_id",
        )

    def minutes(self) -> DataFrame:
        """Stored one-minute candles: one row per (symbol, minute)."""
        return candles(self.ticks(), 60).withColumnRenamed("ts", "open_time")

    def event_dim(self) -> DataFrame:
        return self.read("events").select(
            F.col("event_type").alias("symbol"),
            F.upper("event_type").alias("base_asset"),
            F.when(F.col("event_type") == "error", "BREAK").when(F.col("event_type") != "signup", "TRADING").alias("status"),
        ).distinct()

    def event_ticker(self) -> DataFrame:
        """Daily snapshot per event type; volume in thousands so that tops differ."""
        day = F.date_trunc("day", F.col("open_time").cast("timestamp"))
        bars = self.ticks().groupBy("symbol", day.alias("snapshot_time")).agg(
            F.min_by("close", "open_time").alias("first"),
            F.max_by("close", "open_time").alias("last"),
            F.max("high").alias("ask_price"),
            F.min("low").alias("bid_price"),
            F.sum("volume").alias("volume_24h"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        return bars.select(
            "symbol",
            "snapshot_time",
            (F.try_divide(F.col("last") - F.col("first"), F.col("first")) * 100).alias("price_change_pct"),
            "volume_24h",
            (F.col("volume_24h") * 1000).alias("quote_volume_24h"),
            "trade_count",
            "bid_price",
            "ask_price",
            spread_of_ask(F.col("bid_price"), F.col("ask_price")).alias("spread_pct"),
        )

    # --- account market -----------------------------------------------------
    def accounts(self) -> DataFrame:
        """Dimension; household accounts have no status, machinery ones are delisted."""
        segment = F.col("c_mktsegment")
        return self.read("customer").select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"),
            F.col("c_name").alias("base_asset"),
            segment.alias("quote_asset"),
            F.when(segment == "MACHINERY", "BREAK")
            .when(segment != "HOUSEHOLD", "TRADING")
            .alias("status"),
        )

    def account_ticks(self) -> DataFrame:
        return self.read("events").select(
            F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("symbol"),
            F.col("ts").alias("open_time"),
            F.col("value").alias("close"),
            "event_id",
        )

    def raw_ticker(self) -> DataFrame:
        """One snapshot per order, wire-level: several may share (symbol, snapshot_time)."""
        price = F.col("o_totalprice")
        step = F.substring("o_orderpriority", 1, 1).cast("double")
        return self.read("orders").select(
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"),
            F.col("o_orderdate").alias("snapshot_time"),
            (price - 250000).alias("price_change"),
            ((price - 250000) / 2500).alias("price_change_pct"),
            (price / 100).alias("volume_24h"),
            (price * 10000).alias("quote_volume_24h"),
            F.col("o_orderkey").alias("trade_count"),
            price.alias("bid_price"),
            (price + step).alias("ask_price"),
            spread_of_ask(price, price + step).alias("spread_pct"),
            F.col("o_orderkey").alias("ingest"),
        )

    def ticker(self) -> DataFrame:
        """Final view: the last delivered snapshot per (symbol, snapshot_time)."""
        return latest_by_key(self.raw_ticker(), ["symbol", "snapshot_time"], ["ingest"])

    def ticker_as_of(self):
        """Newest snapshot time; the raw rows have it too and need no dedup."""
        return newest(self.raw_ticker(), "snapshot_time")

    def event_day(self):
        """Newest snapshot time of the event market."""
        return self.read("events").select(F.date_trunc("day", F.max("ts").cast("timestamp"))).scalar()

    # --- order books --------------------------------------------------------
    def book_levels(self) -> DataFrame:
        """Accepted lines are bids, returned ones asks, the others by line number; one book per supplier and month."""
        flag, even = F.col("l_returnflag"), F.col("l_linenumber") % 2 == 0
        side = F.when((flag == "A") | ((flag == "N") & even), "bid").otherwise("ask")
        return self.read("lineitem").select(
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
            F.date_trunc("month", F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
            side.alias("side"),
            (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100).alias("price"),
            F.col("l_quantity").alias("qty"),
        )

    def raw_books(self) -> DataFrame:
        return books_from_levels(self.book_levels())

    def books(self) -> DataFrame:
        return order_book_metrics(self.raw_books(), depth_pct=BOOK_DEPTH)

    def latest_books(self) -> DataFrame:
        """Only the newest book of every symbol is built."""
        newest_levels = at_latest(self.book_levels(), ["symbol"], "timestamp")
        return order_book_metrics(books_from_levels(newest_levels), depth_pct=BOOK_DEPTH)

    def books_as_of(self):
        """Newest book time, read from the levels without building books."""
        return newest(self.book_levels(), "timestamp")

    # --- news, chat, forecasts ----------------------------------------------
    def raw_news(self) -> DataFrame:
        """Documents as deliveries: same text, same article; doc_id is the delivery order."""
        start = F.lit("2024-01-01 00:00:00").cast("timestamp")
        minutes = F.make_dt_interval(mins=F.col("doc_id").cast("int"))
        return self.read("documents").select(
            article_id(F.col("text")).alias("article_id"),
            F.substring_index("text", "\n", 1).alias("title"),
            F.col("text").alias("description"),
            F.lit(None).cast("string").alias("content"),
            F.concat(F.lit("http://news.example.com/"), F.col("doc_id").cast("string")).alias("url"),
            F.col("source").alias("source_name"),
            F.concat(F.lit("http://"), F.col("source"), F.lit(".example.com")).alias("source_url"),
            (start + minutes).alias("published_at"),
            F.col("lang").alias("search_query"),
            (start + minutes).alias("extracted_at"),
            "doc_id",
        )

    def news_as_of(self):
        """Newest publication time of the deliveries."""
        return newest(self.raw_news(), "published_at")

    def predictions(self) -> DataFrame:
        """One forecast per order and priority class; pending orders have no actual yet."""
        orders, customers = self.read("orders"), self.read("customer")
        price = F.col("o_totalprice")
        return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderpriority").alias("symbol"),
            F.col("o_orderkey").alias("step_index"),
            F.col("o_orderdate").alias("predicted_at"),
            (F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(1))).alias("target_time"),
            (price * 0.9 + F.col("c_acctbal")).alias("predicted_close"),
            F.when(F.col("o_orderstatus") != "P", price).alias("actual_close"),
        )

    def traces(self) -> DataFrame:
        """Conversations as agent runs: the role of a message stands for the agent, its words for the tools."""
        words = F.split(F.lower("text"), r"\s+")
        return self.read("conversations").select(
            F.col("conv_id").cast("string").alias("session_id"),
            F.array(F.col("role")).alias("agents_called"),
            words.alias("tools_used"),
            F.length("text").cast("bigint").alias("duration_ms"),
        )
