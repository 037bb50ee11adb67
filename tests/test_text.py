"""News, chat, forecasts, signals, reports, streams."""

import datetime as dt
import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom import vocab
from tickloom.functions import text
from tickloom.functions.phrases import PhraseIndex
from tickloom.operators import chat, forecast, news, reports
from tickloom.operators.signals import signal_block, signals
from tickloom.presets import TIMEFRAMES, timeframe
from tickloom.sources.messages import news_flatten
from tickloom.streaming.candles import stream_candles, stream_dedup
from tickloom.streaming.indicators import MomentumStream
from tickloom.vocab import NEWS_CAPS
from tickloom.streaming.sinks import read_new_files, run_available, run_batches


def col(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_entities_examples(spark):
    got = col(spark, ["Bitcoin and Ethereum", "BTC btc eTh", "mass adoption", None, "", "Shiba Inu, near protocol; binance  coin"], text.mentioned_symbols)
    assert got == [["BTCUSDT", "ETHUSDT"], ["BTCUSDT", "ETHUSDT"], [], [], [], ["NEARUSDT", "SHIBUSDT"]]


def test_entities_and_relevance_equal_brute_force(spark):
    rng = random.Random(3)
    pieces = list(vocab.SYMBOL_ALIASES) + vocab.RELEVANT_TERMS + ["shiba", "inu", "coin", "néar", "é", "the", "_", "adoption", "dots", "Link2"]
    texts = ["".join(rng.choice(pieces).upper() if rng.random() < 0.3 else rng.choice(pieces) + rng.choice([" ", ", ", "", "-", "\n", "é", "_"]) for _ in range(rng.randint(0, 6))) for _ in range(600)]
    want = [sorted({s for a, s in vocab.SYMBOL_ALIASES.items() if re.search(rf"\b{re.escape(a)}\b", t, re.I)}) for t in texts]
    assert col(spark, texts, text.mentioned_symbols) == want
    relevant = re.compile(r"\b(?:" + "|".join(map(re.escape, vocab.RELEVANT_TERMS)) + r")\b", re.I)
    assert col(spark, texts, text.is_relevant) == [bool(relevant.search(t)) for t in texts]


TERMS = {"Near": "N", "near protocol": "NP", "near protocol coin": "NPC", "the-graph": "TG", "coin coin": "CC", "é é": "E", "a b": "AB", "b": "B", "": "none"}


def _plain_mentions(value, terms):
    out, low = [], (value or "").lower()
    for term, symbol in terms.items():
        t = term.lower()
        for k in range(len(low)) if t else ():
            whole = not re.match(r"\w", low[k - 1 : k] if k else "") and not re.match(r"\w", low[k + len(t) : k + len(t) + 1])
            if whole and low.startswith(t, k):
                out.append((k, len(t), t, symbol))
    return sorted(out)


def test_phrase_index_equals_brute_force(spark):
    """Places, separators, overlapping terms; nulls, empty and long texts."""
    rng = random.Random(8)
    pieces = ["near", "Protocol", "coin", "the", "graph", "é", "a", "b", "_", "other"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", " ", " ", "-", "  ", "\n", ""]) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    texts += [None, "", " ", "b", "-b-", "coin coin coin", "near protocol coin", "é é é", "x " * 30000 + "a b"]
    want = [_plain_mentions(t, TERMS) for t in texts]
    index = PhraseIndex(TERMS)
    got = col(spark, texts, lambda x: index.mentions(F.lower(F.coalesce(x, F.lit("")))))
    assert [[tuple(m) for m in row] for row in got] == want
    assert col(spark, texts, lambda x: text.mentioned_symbols(x, TERMS)) == [sorted({m[3] for m in row}) for row in want]
    assert col(spark, texts, lambda x: text.is_relevant(x, TERMS)) == [None if t is None else bool(row) for t, row in zip(texts, want)]


def test_places_in_a_long_text_take_time_by_its_length(spark):
    """50,000 places: adding up all words before each of them took minutes."""
    words = ["the"] * 50_000 + ["été", "of", "the"]
    value, terms = " ".join(words), {"the": "T", "of the": "O"}
    want = [(4 * k, 3, "the", "T") for k in range(50_000)] + [(200_004, 6, "of the", "O"), (200_007, 3, "the", "T")]
    began = time.monotonic()
    got = col(spark, [value], lambda x: PhraseIndex(terms).mentions(F.lower(x)))
    assert time.monotonic() - began < 30
    assert [tuple(m) for m in got[0]] == want


def test_places_around_blocks_of_sums(spark):
    """Texts as long as one or more blocks, less or more by a word; terms that begin and end there."""
    rng = random.Random(9)
    counts = sorted({b + d for b in (0, 32, 64, 1024, 2048, 3104) for d in (-2, -1, 0, 1, 2)} - {-2, -1})
    texts = ["".join(rng.choice(["a", "b", "née", "𝒳y"]) + rng.choice([" ", "-", " ¿"]) for _ in range(n)) for n in counts]
    texts += [t[:-1] for t in texts] + [" " + t for t in texts]
    terms = {"a": "A", "née": "N", "née a": "NA", "a b": "AB", "𝒳y": "X"}
    got = col(spark, texts, lambda x: PhraseIndex(terms).mentions(F.lower(x)))
    assert [[tuple(m) for m in row] for row in got] == [_plain_mentions(t, terms) for t in texts]


def test_phrase_index_of_few_kinds_of_terms(spark):
    """Only longer terms, only signs, no terms."""
    texts = ["near protocol", "near  protocol", "c++ and a b", "c+", "", None]
    lowered = lambda x: F.lower(F.coalesce(x, F.lit("")))
    for terms in ({"near protocol": "NP"}, {"c++": "C"}, {"c++": "C", "a b": "AB", "and": "AND"}, {}):
        index = PhraseIndex(terms)
        want = [sorted({m[3] for m in _plain_mentions(t, terms)}) for t in texts]
        assert col(spark, texts, lambda x: index.found(lowered(x))) == want
        assert col(spark, texts, lambda x: index.holds(lowered(x))) == [bool(w) for w in want]
    with pytest.raises(ValueError):
        PhraseIndex({"c++": "C"}).mentions(F.lit(""))
    assert col(spark, texts, lambda x: PhraseIndex({}).mentions(lowered(x))) == [[]] * len(texts)


def test_mentions_of_symbols(spark):
    rows = spark.createDataFrame([("1", "Bitcoin, bitcoin", None), ("2", "", "near protocol"), ("3", None, None)], "article_id string, title string, description string")
    got = sorted(tuple(r) for r in news.mentions(rows).collect())
    assert got == [
        ("1", "title", "BTCUSDT", "bitcoin", 0, 7), ("1", "title", "BTCUSDT", "bitcoin", 9, 7),
        ("2", "description", "NEARUSDT", "near", 0, 4), ("2", "description", "NEARUSDT", "near protocol", 0, 13),
    ]
    assert news.mentions(rows.limit(0)).count() == 0


def test_quality_rules(spark):
    long = "Bitcoin has broken through the $100,000 barrier as institutions invest."
    rows = [(1, "Bitcoin Surges", long), (2, "Big PRESALE now", long), (3, "Bitcoin", "too short"), (4, "Weather", "x" * 60),
            (5, None, long), (6, "Bitcoin", None), (7, "Next shiba 2.0", long), (8, "crypto", "y" * 50)]
    df = spark.createDataFrame(rows, "id int, title string, description string")
    assert sorted(r["id"] for r in news.news_quality(df).collect()) == [1, 5, 8]


def test_article_id_and_clean_text(spark):
    assert col(spark, ["http://a", None], text.article_id) == [hashlib.md5(b).hexdigest() for b in (b"http://a", b"")]
    assert col(spark, ["<p>Hello</p>", "line1\n\nline2", "  a  <b>c</b> ", None], text.clean_text) == ["Hello", "line1 line2", "a c", ""]


@pytest.mark.parametrize(
    "message, want",
    [("Phân tích RSI BTC", ["technical"]), ("What is the MACD?", ["technical"]), ("Show me the order book", ["technical"]),
     ("Tin tức BTC gần nhất", ["news"]), ("Any news about ETH?", ["news"]), ("Should I buy BTC?", ["technical", "news", "deep"]),
     ("Comprehensive analysis of SOL", ["technical", "news", "deep"]), ("Xin chào", []), ("  Hello \n", []), ("What's up", []),
     ("Tell me about blockchain", None), ("my task", ["technical"]), ("one second", ["news"]), ("RSI and news", ["technical", "news", "deep"]),
     ("KHỐI LƯỢNG", ["technical"]), ("hello there friend", None), ("on-chain", ["news"]), ("ama session", ["news"])],
)
def test_intents(spark, message, want):
    assert col(spark, [message], text.intent_labels) == [want]


def test_intents_equal_brute_force(spark):
    def rule(m):
        m = m.strip()
        says = lambda ps: bool(re.search("(?i)(" + "|".join(ps) + ")", m))
        if re.match("(?i)^(" + "|".join(vocab.GREETING_PHRASES) + ")$", m):
            return []
        t, n, c = says(vocab.TECHNICAL_PHRASES), says(vocab.NEWS_PHRASES), says(vocab.COMPREHENSIVE_PHRASES)
        if c or (t and n):
            return ["technical", "news", "deep"]
        return ["technical"] if t else ["news"] if n else None

    rng = random.Random(5)
    bits = ["khối  lượng", "Order\tbook", "tin tức", "muốn  mua", "want to buy", "on chain", "onchain", "risk invest", "nên giữ không", "hey",
            "hi", "price  goal", "xyz", "Wall", "sec", "Phá\nvỡ", "tâm lý", "", "a b c"]
    msgs = [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 2))) for _ in range(300)]
    assert col(spark, msgs, text.intent_labels) == [rule(m) for m in msgs]


def test_news_flatten_caps_and_dates(spark):
    body = ('{"title": "' + "t" * 600 + '", "description": null, "content": "c", "url": "http://a", "image": "i",'
            ' "publishedAt": "2025-09-30T19:38:25Z", "source": {"name": "n", "url": "u"}}')
    bad = '{"title": "x", "publishedAt": "yesterday", "source": {}}'
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    df = spark.createDataFrame([(body,), (bad,)], "b string")
    whole = news_flatten(df, "b", F.lit("q"), now).orderBy(F.desc(F.length("title"))).first()
    assert len(whole["title"]) == 600  # nothing is cut unless asked for
    a, b = news_flatten(df, "b", F.lit("q"), now, NEWS_CAPS).orderBy(F.desc(F.length("title"))).collect()
    assert (len(a["title"]), a["description"], str(a["published_at"]), a["source_name"]) == (500, "", "2025-09-30 19:38:25", "n")
    assert (b["article_id"], str(b["published_at"]), b["url"]) == (hashlib.md5(b"").hexdigest(), "2026-01-01 00:00:00", "")


def articles(spark):
    t = dt.datetime(2025, 9, 30)
    body = "a description that is long enough for the rule about fifty characters"
    rows = [("a", "Bitcoin up", body, t, t), ("a", "Bitcoin up again", body, t, t + dt.timedelta(hours=1)), ("b", "Solana", body, t + dt.timedelta(days=1), t),
            ("c", "token launch", body, t, t)]
    return spark.createDataFrame(rows, "article_id string, title string, description string, published_at timestamp, extracted_at timestamp").withColumn("content", F.lit(None).cast("string")).withColumn("source_name", F.lit("desk"))


def test_news_transform(spark):
    out = {r["article_id"]: r for r in news.news_transform(articles(spark)).collect()}
    assert set(out) == {"a", "b", "c"} and out["a"]["title"] == "Bitcoin up"
    assert out["a"]["symbols"] == ["BTCUSDT"] and out["c"]["symbols"] == [] and out["b"]["image_url"] is None
    assert [r["article_id"] for r in news.news_transform(articles(spark), ["SOLUSDT"]).collect()] == ["b"]


def test_news_reports(spark):
    piped = news.news_transform(articles(spark))
    assert [r["article_id"] for r in news.news_for_symbol(piped, "BTCUSDT", 14).collect()] == ["a"]
    report = {r["symbol"]: r["report"] for r in reports.report_news(piped, 14).collect()}
    assert report["BTCUSDT"].splitlines()[0] == "[2025-09-30 00:00] Bitcoin up"
    assert report["BTCUSDT"].splitlines()[2] == "  Source: desk"


def test_chat_window_orders_and_breaks_ties(spark):
    rows = [("s", 1, i, f"m{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "session string, ts int, seq int, text string")
    got = [r["text"] for r in chat.chat_window(df, "session", ["ts", "seq"]).collect()]
    assert got == [f"m{i}" for i in range(10, 30)]


def test_trace_rollup(spark):
    df = spark.createDataFrame([("s", ["b", "a"], ["x"], 10), ("s", ["a"], [], 30), ("e", [], [], 5)], "session_id string, agents_called array<string>, tools_used array<string>, duration_ms bigint")
    out = {r["session_id"]: r for r in chat.trace_rollup(df).collect()}
    assert (out["s"]["agents"], out["s"]["tools"], out["s"]["avg_ms"], out["s"]["n_runs"]) == (["a", "b"], ["x"], 20.0, 2)
    assert out["e"]["agents"] == []


def test_json_in_text(spark):
    texts = ['Sure: {"agents": ["a", "b"], "reason": "r"} ok', "no json", "{broken", None]
    got = col(spark, texts, lambda c: text.json_in_text(c, "agents array<string>, reason string"))
    assert got[0]["agents"] == ["a", "b"] and got[1] is None and got[3] is None
    assert got[2] is None or got[2]["agents"] is None


def forecasts(spark, n=500):
    rng = np.random.default_rng(1)
    rows = [("A", i, float(a), float(p)) for i, (a, p) in enumerate(zip(rng.integers(1, 9, n), rng.integers(1, 9, n)))]
    rows += [("B", 0, 4.0, 5.0), ("B", 1, None, 7.0), ("B", 2, 0.0, 1.0)]
    return rows, spark.createDataFrame(rows, "symbol string, step_index bigint, actual_close double, predicted_close double")


@pytest.mark.parametrize("chunk", [1, 7, 8192])
def test_direction_accuracy_equals_brute_force(spark, chunk):
    rows, df = forecasts(spark)
    a, p = np.array([r[2] for r in rows if r[0] == "A"]), np.array([r[3] for r in rows if r[0] == "A"])
    want = round(100 * np.mean(np.sign(np.diff(a)) == np.sign(np.diff(p))), 2)
    out = {r[0]: r[1] for r in forecast.direction_accuracy(df, chunk).collect()}
    assert out == {"A": want, "B": 100.0}


def test_forecast_errors_skip_nulls_and_zero(spark):
    row = {r["symbol"]: r for r in forecast.forecast_errors(forecasts(spark)[1]).collect()}["B"]
    assert (row["mae"], row["mape"], row["rmse"]) == (1.0, 25.0, 1.0)


def bars(spark, n=6, **over):
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        r = dict(high=10.0 + i, low=5.0 + i, rsi_14=50.0, macd=0.0, volume=10.0, open=1.0, close=2.0)
        r.update({k: v[i] for k, v in over.items()})
        rows.append(("A", start + dt.timedelta(hours=i), *[r[k] for k in ("open", "high", "low", "close", "volume", "rsi_14", "macd")]))
    return spark.createDataFrame(rows, "symbol string, ts timestamp, open double, high double, low double, close double, volume double, rsi_14 double, macd double")


def signal(spark, **over):
    return signals(bars(spark, len(next(iter(over.values()))), **over)).first()


def test_signal_rules(spark):
    assert signal(spark, rsi_14=[71.0, 71.0])["rsi"] == "OVERBOUGHT (71.0, falling)"
    assert signal(spark, rsi_14=[29.0, 29.0])["rsi"] == "OVERSOLD (29.0, rising)"
    assert signal(spark, rsi_14=[40.0, 70.0])["rsi"] == "NEUTRAL (70.0, rising)"
    assert signal(spark, rsi_14=[40.0, None])["rsi"] == "NEUTRAL (50.0, rising)"
    assert signal(spark, macd=[1.0, 0.0])["macd"] == "BEARISH (0.00, rising)"
    assert signal(spark, macd=[1.0, 1.0])["macd"] == "BULLISH (1.00, falling)"
    assert signal(spark, macd=[-1.0, -2.0])["macd"] == "BEARISH (-2.00, falling)"
    assert signal(spark, volume=[10.0, 30.0])["volume"] == "ABOVE average (1.5x)"
    assert signal(spark, volume=[0.0, 0.0])["volume"] == "NO DATA"


def test_structure_looks_at_five_bars(spark):
    falling = [9.0, 8.0, 7.0, 6.0, 5.0, 4.0]
    assert signal(spark, high=[99.0, 1.0, 1.0, 2.0, 3.0, 4.0])["structure"].startswith("HIGHER")
    assert signal(spark, high=falling, low=falling)["structure"].startswith("LOWER")
    assert signal(spark, high=falling, low=[1.0, 2.0, 1.0, 2.0, 1.0, 2.0])["structure"].startswith("MIXED")
    assert signals(bars(spark, 1)).count() == 0


def test_candle_report_line(spark):
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), 42000.0, 42500.0, 41800.0, 42300.0, 1234.5, 55.0)],
                               "symbol string, ts timestamp, open double, high double, low double, close double, volume double, rsi_14 double")
    assert reports.report_candles(df, TIMEFRAMES["short"].candle_format).first()["report"] == (
        "2024-01-01 00:00 O:42000.0000 H:42500.0000 L:41800.0000 C:42300.0000 V:1,234 RSI:55.0")


def test_signal_block(spark):
    block = signal_block(signals(bars(spark))).first()["signals"].splitlines()
    assert block[0] == "--- Signals ---" and [line.split(":")[0] for line in block[1:]] == ["RSI", "MACD", "VOLUME", "STRUCTURE"]


def test_unknown_preset_is_medium():
    assert timeframe("weekly") is TIMEFRAMES["medium"]


# --- streams --------------------------------------------------------------------
TICK = "symbol string, open_time timestamp, open double, high double, low double, close double, volume double"


def land(spark, path, *minutes):
    start = dt.datetime(2024, 1, 1)
    rows = [("A", start + dt.timedelta(minutes=m), float(m), float(m), float(m), float(m), 1.0) for m in minutes]
    spark.createDataFrame(rows, TICK).coalesce(1).write.mode("append").parquet(path)


def test_stream_candles_hold_back_and_drop_late(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, src, 0, 5, 12)

    def run():
        stream = stream_candles(read_new_files(spark, src, TICK), "10 minutes", "1 minute")
        run_available(stream, out, str(tmp_path / "state"))
        return sorted((r["open"], r["close"], r["volume"]) for r in spark.read.parquet(out).collect())

    assert run() == [(0.0, 5.0, 2.0)]
    land(spark, src, 3, 35)  # minute 3 comes after its window was closed
    assert run() == [(0.0, 5.0, 2.0), (12.0, 12.0, 1.0)]
    assert run() == [(0.0, 5.0, 2.0), (12.0, 12.0, 1.0)]


def test_stream_dedup(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(2):
        land(spark, src, 0, 1)
        run_available(stream_dedup(read_new_files(spark, src, TICK), ["symbol", "open_time"], "open_time", "1 hour"), out, str(tmp_path / "s"))
    assert spark.read.parquet(out).count() == 2


def test_stream_momentum_drops_late_rows_and_repeats_cleanly(spark, tmp_path):
    src = str(tmp_path / "in")
    handler = MomentumStream(spark, str(tmp_path / "out"))
    for minutes in ((0, 1, 2), (1, 3, 4)):
        land(spark, src, *minutes)
        run_batches(read_new_files(spark, src, TICK), handler, str(tmp_path / "state"))
    rows = handler.rows().orderBy("open_time").collect()
    assert [r["close"] for r in rows] == [0.0, 1.0, 2.0, 3.0, 4.0] and rows[-1]["rsi_14"] == 100.0
    last = spark.read.parquet(str(tmp_path / "out/rows/batch=1")).select(TICK_COLUMNS)
    handler(last, 1)  # the same batch again, as after a failure
    assert handler.rows().count() == 5


TICK_COLUMNS = [part.split()[0] for part in TICK.split(", ")]
