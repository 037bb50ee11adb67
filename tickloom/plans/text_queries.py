"""News, chat, forecasts and text reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom import vocab
from tickloom.functions.text import article_id, clean_text, intent_labels
from tickloom.operators import chat as H
from tickloom.operators import forecast as P
from tickloom.operators import news as N
from tickloom.operators import reports as R
from tickloom.plans import candle_queries as CQ
from tickloom.plans import sqlviews as V
from tickloom.plans.book_queries import _signed
from tickloom.plans.registry import query
from tickloom.presets import timeframe
from tickloom.sources.messages import news_flatten
from tickloom.vocab import NEWS_CAPS, NO_CANDLES, NO_NEWS, NO_TICKER

# The given prose is invented, so names that do occur in it stand for coin names.
ALIASES = {"the": "THEUSDT", "with": "WITHUSDT", "une": "UNEUSDT", "des": "DESUSDT", "und": "UNDUSDT", "was": "WITHUSDT"}
PHRASES = {"of the": "OFUSDT", "the and": "ANDUSDT"}
SPAM = ["ouou", "eding"]
RELEVANT = ["the", "les", "und", "by", "pour"]
ORDER = ["doc_id"]


def _word(text: str, term: str) -> str:
    """Whole-word match that treats every Unicode letter as a word character."""
    return f"regexp_matches({text}, '(?i)(^|[^\\p{{L}}\\p{{N}}_]){term}($|[^\\p{{L}}\\p{{N}}_])')"


ALL_TEXT = "title || ' ' || description || ' '"
SYMBOLS_SQL = (
    "array_to_string(list_sort(list_distinct(list_filter(["
    + ", ".join(f"CASE WHEN {_word(ALL_TEXT, a)} THEN '{s}' END" for a, s in ALIASES.items())
    + "], lambda v: v IS NOT NULL))), ',')"
)
QUALITY_SQL = (
    "length(description) >= 50 AND NOT regexp_matches(title, '(?i)("
    + "|".join(SPAM)
    + ")') AND ("
    + " OR ".join(_word("title || ' ' || description", r) for r in RELEVANT)
    + ")"
)


def _joined(df):
    return df.withColumn("symbols", F.array_join("symbols", ","))


@query("article_id", "SELECT page_id, md5(url) AS article_id FROM pages")
def article_id_q(t):
    return t.read("pages").select("page_id", article_id(F.col("url")).alias("article_id"))


@query(
    "clean_text",
    r"""SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS body FROM pages""",
)
def clean_text_q(t):
    return t.read("pages").select("page_id", clean_text(F.col("html")).alias("body"))


@query(
    "news_flatten",
    """SELECT md5(p.url) AS article_id, substr(p.url, 1, 500) AS title, substr(p.html, 1, 1000) AS description,
        substr(p.html, 1, 5000) AS content, substr(p.url, 1, 500) AS url, '' AS image_url,
        CASE WHEN page_id < 25 THEN 'desk' ELSE '' END AS source_name, substr(p.url, 1, 500) AS source_url,
        CASE WHEN page_id < 25 THEN (SELECT max(ts) FROM events) ELSE TIMESTAMP '2024-02-01' + to_minutes(page_id) END AS published_at,
        'crypto' AS search_query, (SELECT max(ts) FROM events) AS extracted_at FROM pages p""",
)
def news_flatten_q(t):
    """Pages as article messages; the first 25 carry an unreadable date."""
    at = F.lit("2024-02-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("page_id").cast("int"))
    early = F.col("page_id") < 25
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    wire = t.read("pages").select(
        F.to_json(
            F.struct(
                F.col("url").alias("title"),
                F.col("html").alias("description"),
                F.col("html").alias("content"),
                "url",
                F.when(early, "soon").otherwise(iso).alias("publishedAt"),
                F.struct(F.when(early, "desk").alias("name"), "url").alias("source"),
            )
        ).alias("body")
    )
    as_of = t.read("events").select(F.max("ts").cast("timestamp")).scalar()
    return news_flatten(wire, "body", F.lit("crypto"), as_of, NEWS_CAPS)


@query("news_dedup", V.with_views("news") + "SELECT article_id, doc_id, source_name FROM news")
def news_dedup(t):
    """First delivery of every text."""
    return N.news_dedup(t.raw_news().select("article_id", "doc_id", "source_name"), ORDER)


@query("news_quality", V.with_views("raw_news") + f"SELECT doc_id, title FROM raw_news WHERE {QUALITY_SQL}")
def news_quality(t):
    return N.news_quality(t.raw_news(), SPAM, RELEVANT).select("doc_id", "title")


def _terms(terms):
    return "|".join(sorted((x.replace(".", "\\.") for x in terms), key=len, reverse=True))


@query(
    "news_quality_default",
    V.with_views("raw_news")
    + "SELECT doc_id FROM raw_news WHERE length(description) >= 50 AND NOT regexp_matches(title, '(?i)("
    + _terms(vocab.SPAM_TITLE_TERMS)
    + ")') AND "
    + _word("title || ' ' || description", "(" + _terms(vocab.RELEVANT_TERMS) + ")"),
)
def news_quality_default(t):
    """The stored term lists."""
    return N.news_quality(t.raw_news()).select("doc_id")


@query("extract_entities", V.with_views("raw_news") + f"SELECT doc_id, {SYMBOLS_SQL} AS symbols FROM raw_news")
def extract_entities(t):
    return _joined(N.with_symbols(t.raw_news(), ALIASES)).select("doc_id", "symbols")


@query(
    "symbol_mentions",
    V.with_views("raw_news")
    + ", f AS (SELECT doc_id, field, lower(x) AS x FROM (SELECT doc_id, title, description FROM raw_news) UNPIVOT (x FOR field IN (title, description))), a(alias, symbol) AS (VALUES "
    + ", ".join(f"('{a}', '{s}')" for a, s in {**ALIASES, **PHRASES}.items())
    + r"""), c AS (SELECT *, string_split(x, alias) AS parts FROM f, a WHERE contains(x, alias)),
        p AS (SELECT *, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS k FROM c),
        o AS (SELECT *, sum(length(part)) OVER (PARTITION BY doc_id, field, alias ORDER BY k) + (k - 1) * length(alias) AS start FROM p)
        SELECT doc_id, field, symbol, alias, CAST(start AS INTEGER) AS start, CAST(length(alias) AS INTEGER) AS length FROM o WHERE k < len(parts)
            AND NOT (start > 0 AND regexp_matches(substr(x, CAST(start AS BIGINT), 1), '[\p{L}\p{N}_]'))
            AND NOT regexp_matches(substr(x, CAST(start AS BIGINT) + length(alias) + 1, 1), '[\p{L}\p{N}_]')""",
)
def symbol_mentions(t):
    """Every place where a title or description names a symbol."""
    return N.mentions(t.raw_news(), {**ALIASES, **PHRASES}, keys=["doc_id"])


@query(
    "entity_filter",
    V.with_views("raw_news", s=f"SELECT doc_id, {SYMBOLS_SQL} AS symbols FROM raw_news")
    + "SELECT doc_id, symbols FROM s WHERE symbols LIKE '%THEUSDT%' OR symbols LIKE '%UNDUSDT%'",
)
def entity_filter(t):
    named = N.with_symbols(t.raw_news(), ALIASES).select("doc_id", "symbols")
    return _joined(N.about(named, ["THEUSDT", "UNDUSDT"]))


TRANSFORMED = V.with_views(
    "news",
    p=f"SELECT *, string_split({SYMBOLS_SQL}, ',') AS symbols FROM news WHERE {QUALITY_SQL}",
)


def _transformed(t, symbols=None):
    return N.news_transform(t.raw_news(), symbols, ALIASES, ORDER, spam=SPAM, relevant=RELEVANT)


@query(
    "news_transform",
    TRANSFORMED
    + """SELECT article_id, title, description, CAST(NULL AS VARCHAR) AS content, url, CAST(NULL AS VARCHAR) AS image_url, source_name,
        source_url, published_at, search_query, published_at AS extracted_at, array_to_string(symbols, ',') AS symbols FROM p""",
)
def news_transform(t):
    return _joined(_transformed(t))


@query(
    "news_for_symbol",
    TRANSFORMED
    + """SELECT article_id, source_name, published_at FROM p WHERE list_contains(symbols, 'THEUSDT')
        AND published_at >= (SELECT max(published_at) FROM raw_news) - INTERVAL 14 DAY ORDER BY published_at DESC, article_id LIMIT 15""",
)
def news_for_symbol(t):
    return N.news_for_symbol(_transformed(t), "THEUSDT", 14, t.news_as_of()).select("article_id", "source_name", "published_at")


@query(
    "news_mentions",
    TRANSFORMED
    + """SELECT symbol, day, count(*) AS n_articles FROM (SELECT unnest(symbols) AS symbol, CAST(published_at AS DATE) AS day FROM p)
        WHERE symbol <> '' GROUP BY 1, 2""",
)
def news_mentions(t):
    return N.news_mentions(_transformed(t))


NEWS_REPORT = TRANSFORMED.rstrip() + """,
        e AS (SELECT unnest(symbols) AS symbol, * EXCLUDE (symbols) FROM p
            WHERE published_at >= (SELECT max(published_at) FROM raw_news) - INTERVAL 3 DAY),
        k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY published_at DESC, article_id) AS rn FROM e WHERE symbol <> '' QUALIFY rn <= 15),
        y AS (SELECT symbol, string_agg('[' || strftime(published_at, '%Y-%m-%d %H:%M') || '] ' || substr(title, 1, 120) || chr(10) || '  '
            || substr(description, 1, 200) || chr(10) || '  Source: ' || source_name, chr(10) ORDER BY rn) AS report FROM k GROUP BY 1)
        """


@query("report_news", NEWS_REPORT + "SELECT symbol, report FROM y")
def report_news(t):
    """Newest 15 articles per symbol as text."""
    return R.report_news(_transformed(t), 3, t.news_as_of())


@query(
    "report_news_all",
    NEWS_REPORT
    + f"""SELECT d.symbol, coalesce(report, '{NO_NEWS}') AS report
        FROM (SELECT unnest({sorted(set(ALIASES.values()))}) AS symbol UNION SELECT r_name FROM region) d LEFT JOIN y ON y.symbol = d.symbol""",
)
def report_news_all(t):
    """The same for a dimension that also lists symbols without news (the regions)."""
    listed = t.spark.sql("SELECT explode(array({})) AS symbol".format(", ".join(f"'{s}'" for s in sorted(set(ALIASES.values())))))
    dim = listed.unionByName(t.read("region").select(F.col("r_name").alias("symbol")))
    return R.for_every_symbol(R.report_news(_transformed(t), 3, t.news_as_of()), dim, NO_NEWS)


# --- chat ---------------------------------------------------------------------
@query(
    "chat_window",
    """SELECT conv_id, turn, role, text FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 4""",
)
def chat_window(t):
    """Newest two exchanges of every conversation."""
    return H.chat_window(t.read("conversations"), "conv_id", ["turn"], turns=2)


@query("chat_window_default", """SELECT conv_id, turn, role, text FROM conversations
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 20""")
def chat_window_default(t):
    """Newest ten exchanges of every conversation."""
    return H.chat_window(t.read("conversations"), "conv_id", ["turn"])


@query("chat_history", "SELECT conv_id, turn, role, text FROM conversations")
def chat_history(t):
    return H.chat_history(t.read("conversations"), "conv_id", ["turn"])


def _says(phrases):
    return "regexp_matches(msg, '(?i)(" + "|".join(phrases).replace("'", "''") + ")')"


INTENT_SQL = f"""CASE WHEN regexp_matches(msg, '(?i)^({"|".join(vocab.GREETING_PHRASES).replace("'", "''")})$') THEN ''
    WHEN {_says(vocab.COMPREHENSIVE_PHRASES)} OR ({_says(vocab.TECHNICAL_PHRASES)} AND {_says(vocab.NEWS_PHRASES)}) THEN 'technical,news,deep'
    WHEN {_says(vocab.TECHNICAL_PHRASES)} THEN 'technical' WHEN {_says(vocab.NEWS_PHRASES)} THEN 'news' END"""


@query(
    "intent_labels",
    f"SELECT conv_id, turn, {INTENT_SQL} AS labels FROM (SELECT *, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS msg FROM conversations)",
)
def intent_labels_q(t):
    labels = F.array_join(intent_labels(F.col("text")), ",").alias("labels")
    return t.read("conversations").select("conv_id", "turn", labels)


@query(
    "chat_context",
    """SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'C' || conv_id END AS symbol,
        CASE WHEN role = 'assistant' THEN role || ',' || turn END AS decision FROM conversations""",
)
def chat_context(t):
    """JSON summaries inside assistant texts; other messages carry none."""
    body = F.to_json(
        F.struct(
            F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("symbol"),
            F.array("role", F.col("turn").cast("string")).alias("supervisor_decision"),
        )
    )
    noisy = F.when(F.col("role") == "assistant", F.concat(F.lit("Sure: "), body, F.lit(" done"))).otherwise("none")
    out = H.with_context(t.read("conversations").select("conv_id", "turn", noisy.alias("context_summary")))
    return out.select(
        "conv_id", "turn", "context.symbol", F.array_join("context.supervisor_decision", ",").alias("decision")
    )


@query(
    "trace_rollup",
    r"""SELECT CAST(conv_id AS VARCHAR) AS session_id, count(*) AS n_runs, CAST(sum(length(text)) AS BIGINT) AS total_ms,
        round(avg(length(text)), 6) AS avg_ms, array_to_string(list_sort(list_distinct(list(role))), ',') AS agents,
        array_to_string(list_sort(list_distinct(flatten(list(regexp_split_to_array(lower(text), '\s+'))))), ',') AS tools
        FROM conversations GROUP BY 1""",
)
def trace_rollup(t):
    out = H.trace_rollup(t.traces())
    return out.withColumns(
        {"avg_ms": F.round("avg_ms", 6), "agents": F.array_join("agents", ","), "tools": F.array_join("tools", ",")}
    )


# --- forecasts ------------------------------------------------------------------
@query(
    "forecast_errors",
    V.with_views("predictions")
    + """SELECT symbol, round(avg(abs(actual_close - predicted_close)), 4) AS mae,
        round(avg(abs(actual_close - predicted_close) / nullif(actual_close, 0) * 100), 4) AS mape,
        round(sqrt(avg(power(actual_close - predicted_close, 2))), 4) AS rmse FROM predictions
        WHERE actual_close IS NOT NULL GROUP BY 1""",
)
def forecast_errors(t):
    return P.forecast_errors(t.predictions())


@query(
    "direction_accuracy",
    V.with_views(
        "predictions",
        d="""SELECT symbol, actual_close - lag(actual_close) OVER w AS ad, predicted_close - lag(predicted_close) OVER w AS pd
            FROM predictions WHERE actual_close IS NOT NULL WINDOW w AS (PARTITION BY symbol ORDER BY step_index)""",
    )
    + """SELECT symbol, round(count(*) FILTER (WHERE sign(ad) = sign(pd)) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS direction_accuracy
        FROM d WHERE ad IS NOT NULL GROUP BY 1""",
)
def direction_accuracy(t):
    return P.direction_accuracy(t.predictions())


FORECAST = V.with_views(
    "ticks",
    f="""SELECT symbol, open_time AS predicted_at, open_time + INTERVAL 1 HOUR AS target_time, close * 1.01 AS predicted_close
        FROM ticks""",
    b="""SELECT symbol, min(predicted_at) AS lo, max(newest) + INTERVAL 1 HOUR AS hi
        FROM (SELECT *, max(predicted_at) OVER (PARTITION BY symbol) AS newest FROM f) WHERE predicted_at >= newest - INTERVAL 24 HOUR
        GROUP BY 1""",
)


def _event_forecasts(t):
    return t.ticks().select(
        "symbol",
        F.col("open_time").alias("predicted_at"),
        (F.col("open_time") + F.make_dt_interval(hours=F.lit(1))).alias("target_time"),
        (F.col("close") * 1.01).alias("predicted_close"),
    )


@query(
    "forecast_overlay",
    FORECAST
    + """SELECT t.symbol, open_time + INTERVAL 7 HOUR AS time, close AS actual_close FROM ticks t JOIN b ON b.symbol = t.symbol
        WHERE open_time BETWEEN lo AND hi""",
)
def forecast_overlay(t):
    return P.forecast_overlay(t.ticks(), _event_forecasts(t))


@query(
    "forecast_series",
    FORECAST
    + """SELECT symbol, target_time + INTERVAL 7 HOUR AS time, predicted_close FROM f
        QUALIFY predicted_at >= max(predicted_at) OVER (PARTITION BY symbol) - INTERVAL 24 HOUR""",
)
def forecast_series(t):
    return P.forecast_series(_event_forecasts(t))


# --- reports --------------------------------------------------------------------
CANDLE_LINE = f"""strftime(ts, '%Y-%m-%d %H:00') || ' O:' || format('{{:.4f}}', open) || ' H:' || format('{{:.4f}}', high)
    || ' L:' || format('{{:.4f}}', low) || ' C:' || format('{{:.4f}}', close) || ' V:' || format('{{:,.0f}}', volume)
    || ' RSI:' || format('{{:.1f}}', rsi)"""
BARS = f"SELECT c.*, {V.RSI_OF_MEANS} AS rsi, e12 - e26 AS macd FROM c JOIN r ON r.symbol = c.symbol AND r.ts = c.ts"


@query(
    "report_candles",
    CQ.INDICATED.rstrip()
    + f""", i AS ({BARS}) SELECT symbol, string_agg({CANDLE_LINE}, chr(10) ORDER BY ts) AS report FROM i GROUP BY 1""",
)
def report_candles(t):
    """Medium preset: one line per 4-hour candle."""
    return R.report_candles(CQ._medium(t), timeframe("medium").candle_format)


@query(
    "report_candles_all",
    CQ.INDICATED.rstrip()
    + f""", i AS ({BARS}), y AS (SELECT symbol, string_agg({CANDLE_LINE}, chr(10) ORDER BY ts) AS report FROM i GROUP BY 1)
        SELECT d.symbol, coalesce(report, '{NO_CANDLES}') AS report
        FROM (SELECT DISTINCT event_type AS symbol FROM events UNION SELECT r_name FROM region) d LEFT JOIN y ON y.symbol = d.symbol""",
)
def report_candles_all(t):
    """The same for a dimension that also lists symbols without candles (the regions)."""
    dim = t.event_dim().select("symbol").unionByName(t.read("region").select(F.col("r_name").alias("symbol")))
    return R.for_every_symbol(R.report_candles(CQ._medium(t), timeframe("medium").candle_format), dim, NO_CANDLES)


@query(
    "market_report",
    CQ.INDICATED.rstrip()
    + f""", i AS ({BARS}), g AS (SELECT symbol, rsi AS s1, macd AS s2, volume AS s3, structure AS s4 FROM ({CQ.SIGNALS_SQL})),
        k AS (SELECT symbol, string_agg({CANDLE_LINE}, chr(10) ORDER BY ts) AS body, count(*) AS n, arg_max(close, ts) AS last,
            arg_max(rsi, ts) AS last_rsi, arg_max(macd, ts) AS last_macd FROM i GROUP BY 1)
        SELECT k.symbol, body || chr(10) || chr(10) || '--- Summary ---' || chr(10) || 'Candles: ' || n
            || ' (Medium-term (weeks → month))' || chr(10) || 'Latest close: ' || format('{{:.4f}}', last) || chr(10)
            || 'RSI(14): ' || format('{{:.6f}}', last_rsi) || chr(10) || 'MACD: ' || format('{{:.6f}}', last_macd) || chr(10) || chr(10)
            || '--- Signals ---' || chr(10) || 'RSI: ' || s1 || chr(10) || 'MACD: ' || s2 || chr(10) || 'VOLUME: ' || s3 || chr(10)
            || 'STRUCTURE: ' || s4 AS report
        FROM k JOIN g ON g.symbol = k.symbol""",
)
def market_report(t):
    """Candles, summary and signals of the medium preset."""
    return R.market_report(t.ticks(), timeframe("medium"))


TICKER_VIEWS = {
    "d": """SELECT symbol, date_trunc('day', snapshot_time) AS ts, avg(volume_24h) AS v, avg(spread_pct) AS s, avg(price_change_pct) AS p
        FROM event_ticker WHERE snapshot_time >= (SELECT max(snapshot_time) FROM event_ticker) - INTERVAL 30 DAY GROUP BY 1, 2""",
    "x": f"""SELECT symbol, string_agg(strftime(ts, '%Y-%m-%d') || ' Vol:' || format('{{:,.0f}}', v) || ' Spread:' || format('{{:.4f}}', s)
        || '% PriceChg:' || {_signed('p', 2)} || '%', chr(10) ORDER BY ts) AS trend FROM d GROUP BY 1""",
    "l": "SELECT * FROM event_ticker QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY snapshot_time DESC) = 1",
}
SNAPSHOT = f"""chr(10) || chr(10) || '--- Latest 24h snapshot ---' || chr(10) || 'Price change: '
    || {_signed('price_change_pct', 2)} || '%' || chr(10) || 'Volume 24h: ' || format('{{:,.0f}}', coalesce(volume_24h, 0)) || chr(10)
    || 'Bid-ask spread: ' || format('{{:.4f}}', coalesce(spread_pct, 0)) || '%'"""


@query(
    "report_ticker",
    V.with_views("event_ticker", **TICKER_VIEWS) + f"SELECT l.symbol, trend || {SNAPSHOT} AS report FROM l JOIN x ON x.symbol = l.symbol",
)
def report_ticker(t):
    """Medium preset of the event market."""
    return R.ticker_report(t.event_ticker(), timeframe("medium"))


def listed_ticker_sql(symbols: str) -> str:
    """Reports of the listed symbols, with or without snapshots."""
    return V.with_views("event_ticker", **TICKER_VIEWS) + f"""SELECT n.symbol, coalesce(trend, '{NO_TICKER}') || {SNAPSHOT} AS report
        FROM ({symbols}) n LEFT JOIN l ON l.symbol = n.symbol LEFT JOIN x ON x.symbol = n.symbol"""


@query("report_ticker_all", listed_ticker_sql("SELECT DISTINCT event_type AS symbol FROM events UNION SELECT r_name FROM region"))
def report_ticker_all(t):
    """The same for a dimension that also lists symbols without snapshots (the regions)."""
    dim = t.event_dim().select("symbol").unionByName(t.read("region").select(F.col("r_name").alias("symbol")))
    return R.ticker_report(t.event_ticker(), timeframe("medium"), dim=dim)
