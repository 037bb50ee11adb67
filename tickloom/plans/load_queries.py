"""Incremental loading, dimension upkeep, gaps and time filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.functions.labels import is_trading
from tickloom.operators import load as L
from tickloom.plans import sqlviews as V
from tickloom.plans.registry import query
from tickloom.sources import lake

CUT = "2000-01-01 00:00:00"
SLIM = ["symbol", "snapshot_time", "quote_volume_24h", "ingest"]
SLIM_SQL = ", ".join(SLIM)


def _split(t):
    """Snapshots loaded so far (on time) and the full delivery that arrives next."""
    rows = t.raw_ticker().select(*SLIM)
    cut = F.lit(CUT).cast("timestamp_ntz")
    return rows.where(F.col("snapshot_time") < cut), rows


LOADED = f"SELECT {SLIM_SQL} FROM raw_ticker WHERE snapshot_time < TIMESTAMP '{CUT}'"
MARKS = "SELECT symbol, max(snapshot_time) AS mark FROM loaded GROUP BY 1"


@query("watermarks", V.with_views("raw_ticker") + "SELECT symbol, max(snapshot_time) AS watermark FROM raw_ticker GROUP BY 1")
def watermarks(t):
    return L.watermarks(t.raw_ticker(), ["symbol"], "snapshot_time")


@query("watermark_global", V.with_views("raw_news") + "SELECT max(published_at) AS watermark FROM raw_news")
def watermark_global(t):
    return L.watermarks(t.raw_news(), [], "published_at")


@query(
    "incremental_load",
    V.with_views("raw_ticker", loaded=LOADED, marks=MARKS)
    + f"""SELECT {', '.join('n.' + c for c in SLIM)} FROM raw_ticker n LEFT JOIN marks m ON m.symbol = n.symbol
        WHERE mark IS NULL OR snapshot_time > mark""",
)
def incremental_load(t):
    loaded, new = _split(t)
    return L.incremental(new, loaded, ["symbol"], "snapshot_time")


@query(
    "incremental_load_global",
    V.with_views("raw_news")
    + """SELECT article_id, doc_id FROM raw_news WHERE published_at >
        (SELECT max(published_at) FROM raw_news WHERE published_at < TIMESTAMP '2024-01-01 02:00:00')""",
)
def incremental_load_global(t):
    """News load: one watermark for the whole table."""
    rows = t.raw_news().select("article_id", "doc_id", "published_at")
    loaded = rows.where(F.col("published_at") < F.lit("2024-01-01 02:00:00").cast("timestamp"))
    return L.incremental(rows, loaded, [], "published_at").select("article_id", "doc_id")


@query(
    "late_rows",
    V.with_views("raw_ticker", loaded=LOADED, marks=MARKS)
    + f"""SELECT {', '.join('n.' + c for c in SLIM)} FROM raw_ticker n JOIN marks m ON m.symbol = n.symbol
        WHERE snapshot_time <= mark""",
)
def late_rows(t):
    """What the strict watermark drops."""
    loaded, new = _split(t)
    return L.late_rows(new, loaded, ["symbol"], "snapshot_time")


@query(
    "late_recompute_month",
    V.with_views(
        "raw_ticker",
        loaded=f"SELECT {SLIM_SQL} FROM raw_ticker WHERE snapshot_time < TIMESTAMP '{CUT}' AND quote_volume_24h >= 5e8",
        marks=MARKS,
        j=f"""SELECT n.*, mark, mark IS NULL OR snapshot_time > mark AS fresh, strftime(snapshot_time, '%Y-%m') AS month
            FROM (SELECT {SLIM_SQL} FROM raw_ticker) n LEFT JOIN marks m ON m.symbol = n.symbol""",
        late="""SELECT DISTINCT symbol, month FROM j WHERE NOT fresh
            AND (symbol, snapshot_time) NOT IN (SELECT (symbol, snapshot_time) FROM loaded)""",
    )
    + f"""SELECT {', '.join('j.' + c for c in SLIM)} FROM j LEFT JOIN late ON late.symbol = j.symbol AND late.month = j.month
        WHERE fresh OR late.symbol IS NOT NULL""",
)
def late_recompute_month(t):
    """Late rows pull their whole month back in."""
    rows = t.raw_ticker().select(*SLIM)
    cut = F.lit(CUT).cast("timestamp_ntz")
    loaded = rows.where((F.col("snapshot_time") < cut) & (F.col("quote_volume_24h") >= 5e8))
    return L.incremental(rows, loaded, ["symbol"], "snapshot_time", late_policy="recompute_month")


@query(
    "upsert_merge",
    V.with_views(
        "raw_ticker",
        loaded=LOADED,
        new=f"""SELECT symbol, snapshot_time, quote_volume_24h * 2 AS quote_volume_24h, ingest FROM raw_ticker
            WHERE snapshot_time >= TIMESTAMP '1999-01-01'""",
        merged=f"SELECT 0 AS batch, {SLIM_SQL} FROM loaded UNION ALL SELECT 1, {SLIM_SQL} FROM new",
    )
    + f"""SELECT {SLIM_SQL} FROM merged
        QUALIFY row_number() OVER (PARTITION BY symbol, snapshot_time ORDER BY batch DESC, ingest DESC) = 1""",
)
def upsert_merge(t):
    """A corrected delivery that overlaps the loaded year."""
    loaded, rows = _split(t)
    new = rows.where(F.col("snapshot_time") >= F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))
    new = new.withColumn("quote_volume_24h", F.col("quote_volume_24h") * 2)
    return L.upsert(loaded, new, ["symbol", "snapshot_time"], ["ingest"])


@query(
    "union_evolve",
    """SELECT 'C' || o_custkey AS symbol, o_totalprice AS close, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS segment
        FROM orders UNION ALL SELECT 'C' || c_custkey, NULL, NULL, c_mktsegment FROM customer
        UNION ALL SELECT 'C' || o_custkey, NULL, o_orderstatus, NULL FROM orders""",
)
def union_evolve(t):
    """Three frames with different columns."""
    orders, customers = t.read("orders"), t.read("customer")
    account = F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol")
    return L.union_evolving(
        orders.select(account, F.col("o_totalprice").alias("close")),
        customers.select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"),
            F.col("c_mktsegment").alias("segment"),
        ),
        orders.select(account, F.col("o_orderstatus").alias("status")),
    )


@query(
    "insert_new_symbols",
    V.with_views("accounts", "account_ticks")
    + """SELECT symbol, base_asset, quote_asset, status FROM accounts
        WHERE symbol NOT IN (SELECT symbol FROM account_ticks)""",
)
def insert_new_symbols(t):
    return L.insert_new(t.account_ticks(), t.accounts(), "symbol")


@query(
    "delete_predicate",
    "SELECT conv_id, turn, role FROM conversations WHERE NOT (conv_id IN (SELECT conv_id FROM conversations WHERE role = 'system'))",
)
def delete_predicate(t):
    """Remove every session that holds a system message."""
    rows = t.read("conversations").select("conv_id", "turn", "role")
    doomed = rows.where(F.col("role") == "system").select("conv_id").distinct().withColumn("doomed", F.lit(True))
    marked = rows.join(doomed, "conv_id", "left")
    return L.delete_where(marked, F.col("doomed")).drop("doomed")


@query(
    "load_order_book",
    V.with_views("levels")
    + """SELECT symbol, timestamp, count(*) AS n FROM levels WHERE timestamp > TIMESTAMP '2000-01-01' GROUP BY 1, 2""",
)
def load_order_book(t):
    """Books after 2000-01-01; the re-sent ones arrive with fractions of a second and are not loaded again."""
    cut = F.lit("2000-01-01 00:00:00").cast("timestamp")
    sizes = t.raw_books().select("symbol", "timestamp", (F.size("bids") + F.size("asks")).cast("bigint").alias("n"))
    marks = t.read("supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"), cut.alias("timestamp")
    )
    sent = sizes.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(secs=F.lit(0.25)))
    return L.load_order_book(sent, marks)


@query("dim_list", V.with_views("accounts") + "SELECT symbol FROM accounts")
def dim_list(t):
    return t.accounts().select("symbol").distinct().orderBy("symbol")


PAIR = "c_mktsegment || CASE WHEN c_acctbal >= 0 THEN 'USDT' ELSE 'BTC' END"


@query(
    "dim_symbols",
    f"""SELECT DISTINCT symbol, regexp_replace(symbol, 'USDT$', '') AS base_asset,
        CASE WHEN symbol LIKE '%USDT' THEN 'USDT' ELSE '' END AS quote_asset FROM (SELECT {PAIR} AS symbol FROM customer)""",
)
def dim_symbols(t):
    """Dimension rows from trading-pair names."""
    quote = F.when(F.col("c_acctbal") >= 0, "USDT").otherwise("BTC")
    return lake.dim_from_symbols(t.read("customer").select(F.concat("c_mktsegment", quote).alias("symbol")))


@query(
    "trading_only",
    V.with_views("accounts") + "SELECT symbol, status FROM accounts WHERE coalesce(status, 'TRADING') = 'TRADING'",
)
def trading_only(t):
    return t.accounts().select("symbol", "status").where(is_trading(F.col("status")))


@query(
    "load_audit",
    V.with_views("raw_ticker")
    + """SELECT count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols, min(snapshot_time) AS first_ts,
        max(snapshot_time) AS last_ts FROM raw_ticker""",
)
def load_audit(t):
    return L.load_audit(t.raw_ticker(), "symbol", "snapshot_time")


@query(
    "derive_month",
    V.with_views("ticks") + "SELECT strftime(open_time, '%Y-%m') AS month, symbol, count(*) AS n FROM ticks GROUP BY 1, 2",
)
def derive_month(t):
    rows = lake.derive_month(t.ticks())
    return rows.groupBy("month", "symbol").agg(F.count(F.lit(1)).alias("n"))


@query(
    "month_filter",
    V.with_views("raw_ticker")
    + f"""SELECT {SLIM_SQL} FROM raw_ticker
        WHERE snapshot_time >= TIMESTAMP '1998-12-01' AND snapshot_time < TIMESTAMP '1999-01-01'""",
)
def month_filter(t):
    return times.in_month(t.raw_ticker().select(*SLIM), "snapshot_time", "1998-12")


@query(
    "epoch_normalize",
    """SELECT event_id, epoch_us(ts) // 1000 AS open_time, to_milliseconds(epoch_us(ts) // 1000) + TIMESTAMP '1970-01-01' AS at FROM events""",
)
def epoch_normalize(t):
    """Epochs in ms for clicks, in µs for all other events, brought to ms."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    raw = F.when(F.col("event_type") == "click", F.floor(micros / 1000).cast("bigint")).otherwise(micros)
    return t.read("events").select("event_id", raw.alias("raw")).select(
        "event_id", times.epoch_millis(F.col("raw")).alias("open_time"), times.from_epoch(F.col("raw")).alias("at")
    )


@query(
    "closed_candle_filter",
    V.with_views("minutes")
    + f"""SELECT symbol, open_time, close FROM minutes WHERE open_time <=
        {V.bucket("(SELECT max(ts) FROM events)", 60)} - INTERVAL 60 SECOND""",
)
def closed_candle_filter(t):
    """Every minute candle that is closed at the newest event."""
    rows = t.minutes().select("symbol", "open_time", "close")
    return L.closed_only(rows, "open_time", times.newest(t.read("events"), "ts"))


@query(
    "target_months",
    """SELECT m.month, count(*) AS n FROM (SELECT date_trunc('month', (SELECT max(o_orderdate) FROM orders)) - to_months(CAST(i AS INTEGER)) AS month
        FROM range(1, 37) r(i)) m JOIN orders ON date_trunc('month', o_orderdate) = m.month GROUP BY 1""",
)
def target_months(t):
    """Orders of the last 36 completed months before the newest order."""
    orders = t.read("orders")
    months = orders.agg(F.explode(times.completed_months(F.max("o_orderdate"), 36)).alias("month"))
    rows = orders.select(F.trunc("o_orderdate", "month").alias("month")).groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(months, "month").withColumn("month", F.col("month").cast("timestamp"))


@query(
    "gap_ranges",
    V.with_views(
        "accounts", "account_ticks",
        w="SELECT symbol, max(open_time) AS watermark FROM account_ticks GROUP BY 1",
        e=f"""SELECT a.symbol, watermark, CASE WHEN coalesce(status, 'TRADING') <> 'TRADING' THEN TIMESTAMP '2024-01-15'
            ELSE {V.bucket('(SELECT max(ts) FROM events)', 60)} - INTERVAL 60 SECOND END AS fetch_to
            FROM accounts a LEFT JOIN w ON w.symbol = a.symbol""",
    )
    + """SELECT symbol, date_trunc('second', watermark) + INTERVAL 60 SECOND AS fetch_from, fetch_to, watermark IS NULL AS bootstrap
        FROM e WHERE watermark IS NULL OR date_trunc('second', watermark) + INTERVAL 60 SECOND <= fetch_to""",
)
def gap_ranges(t):
    """Range still to fetch per account; machinery accounts were delisted on 2024-01-15."""
    dim = t.accounts().withColumn("break_date", F.when(F.col("status") == "BREAK", "2024-01-15"))
    return L.gap_ranges(dim, t.account_ticks(), "open_time", times.newest(t.read("events"), "ts"))


@query(
    "missing_candles",
    V.with_views(
        "ticks",
        h="SELECT DISTINCT symbol, date_trunc('hour', open_time) AS open_time FROM ticks",
        g="SELECT symbol, unnest(generate_series(min(open_time), max(open_time), INTERVAL 1 HOUR)) AS open_time FROM h GROUP BY 1",
    )
    + "SELECT g.symbol, g.open_time FROM g ANTI JOIN h ON h.symbol = g.symbol AND h.open_time = g.open_time",
)
def missing_candles(t):
    """Hours without an event per event type."""
    return L.missing_candles(t.ticks(), "open_time", 3600)
