import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import ewm as E
from tickloom.operators import indicators as I
from tickloom.operators.candles import candles
from tickloom.operators.ewm import Mean, ewm


def pandas_rsi(close, n=14):
    delta = close.diff()
    gain = delta.clip(lower=0).ewm(span=n, adjust=False).mean()
    loss = (-delta).clip(lower=0).ewm(span=n, adjust=False).mean()
    return (100 - 100 / (1 + gain / loss)).fillna(0.0)


def frame(spark, series):
    """{symbol: closes} as minute candles; every seventh minute is missing."""
    start = dt.datetime(2024, 1, 1)
    rows = []
    for symbol, closes in series.items():
        for i, c in enumerate(closes):
            rows.append((symbol, start + dt.timedelta(minutes=i + i // 6), float(c)))
    return spark.createDataFrame(rows, "symbol string, open_time timestamp, close double")


def values(df, symbol, column):
    rows = df.where(F.col("symbol") == symbol).orderBy("open_time").select(column).collect()
    return np.array([r[0] for r in rows], dtype=float)


@pytest.fixture(scope="module")
def walk():
    rng = np.random.default_rng(7)
    return {s: 100 + np.cumsum(rng.normal(size=n)).round(2) for s, n in (("A", 3000), ("B", 700), ("C", 1))}


@pytest.mark.parametrize("span", [2, 9, 12, 14, 26, 200])
def test_ewm_equals_pandas(spark, walk, span):
    out = ewm(frame(spark, walk), "symbol", "open_time", 60, [Mean("close", span, "y")])
    for symbol, closes in walk.items():
        want = pd.Series(closes).ewm(span=span, adjust=False).mean()
        np.testing.assert_allclose(values(out, symbol, "y"), want, rtol=1e-11)


@pytest.mark.parametrize("chunk", [1, 2, 7, 64])
def test_momentum_equals_pandas_for_any_chunk(spark, walk, monkeypatch, chunk):
    monkeypatch.setattr(E, "CHUNK_STEPS", chunk)
    short = {s: c[:400] for s, c in walk.items()}
    out = I.momentum(frame(spark, short))
    for symbol, closes in short.items():
        close = pd.Series(closes)
        np.testing.assert_allclose(values(out, symbol, "rsi_14"), pandas_rsi(close), rtol=1e-9, atol=1e-9)
        line = close.ewm(span=12, adjust=False).mean() - close.ewm(span=26, adjust=False).mean()
        np.testing.assert_allclose(values(out, symbol, "macd"), line, rtol=1e-9, atol=1e-9)


def test_macd_signal_equals_pandas(spark, walk):
    out = I.macd(frame(spark, walk))
    for symbol, closes in walk.items():
        close = pd.Series(closes)
        line = close.ewm(span=12, adjust=False).mean() - close.ewm(span=26, adjust=False).mean()
        want = line.ewm(span=9, adjust=False).mean()
        np.testing.assert_allclose(values(out, symbol, "macd_signal"), want, rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose(values(out, symbol, "macd_hist"), line - want, atol=1e-9)


def test_rsi_edges(spark):
    up = [100 + i for i in range(20)]
    series = {"up": up, "flat": [5.0] * 20, "down": up[::-1], "halt": [1, 2, 1.5] + [1.5] * 30}
    out = I.rsi_ewm(frame(spark, series))
    assert list(values(out, "up", "rsi_14")) == [0.0] + [100.0] * 19
    assert list(values(out, "flat", "rsi_14")) == [0.0] * 20
    assert list(values(out, "down", "rsi_14")) == [0.0] * 20
    np.testing.assert_allclose(values(out, "halt", "rsi_14"), pandas_rsi(pd.Series(series["halt"])), rtol=1e-9)


def test_two_runs_with_carry_equal_one_run(spark, walk):
    df = frame(spark, walk)
    cut = F.lit("2024-01-01 09:13:00").cast("timestamp")
    whole = I.momentum(df)
    first = I.momentum(df.where(F.col("open_time") < cut), keep_means=True)
    second = I.momentum(df.where(F.col("open_time") >= cut), carry=I.momentum_state(first))
    for symbol in walk:
        for column in ("rsi_14", "macd"):
            got = np.concatenate([values(first, symbol, column), values(second, symbol, column)])
            np.testing.assert_allclose(got, values(whole, symbol, column), rtol=1e-9, atol=1e-9)


def test_carry_for_an_unknown_symbol_starts_afresh(spark, walk):
    state = I.momentum_state(I.momentum(frame(spark, {"A": walk["A"]}), keep_means=True))
    new = frame(spark, {"B": walk["B"]})
    np.testing.assert_allclose(
        values(I.momentum(new, carry=state), "B", "rsi_14"), values(I.momentum(new), "B", "rsi_14"), rtol=1e-12
    )


def test_rsi_sma_edges(spark):
    rows = [(s, i, float(c)) for s, cs in {"flat": [5] * 16, "up": range(16), "mix": [1, 2] * 8}.items() for i, c in enumerate(cs)]
    out = I.rsi_sma(spark.createDataFrame(rows, "symbol string, ts bigint, close double")).orderBy("ts")
    got = {s: [r["rsi"] for r in out.where(F.col("symbol") == s).collect()] for s in ("flat", "up", "mix")}
    assert got["flat"] == [None] * 14 + [50.0] * 2
    assert got["up"] == [None] * 14 + [100.0] * 2
    assert got["mix"][14:] == [50.0, pytest.approx(50.0)]


def bars(spark):
    start = dt.datetime(2024, 1, 1, 0, 30)
    rows = [("A", start + dt.timedelta(hours=i), float(i), i + 2.0, i - 1.0, i + 1.0, 10.0) for i in range(48)]
    return spark.createDataFrame(
        rows, "symbol string, open_time timestamp, open double, high double, low double, close double, volume double"
    )


def test_candles_first_last_high_low(spark):
    day = candles(bars(spark), "day").orderBy("ts").collect()
    assert (day[0]["open"], day[0]["high"], day[0]["low"], day[0]["close"], day[0]["volume"]) == (0, 25, -1, 24, 240)


def test_limit_keeps_oldest_or_latest(spark):
    df = bars(spark)
    old = [r["open"] for r in candles(df, "hour", limit=3).orderBy("ts").collect()]
    new = [r["open"] for r in candles(df, "hour", limit=3, keep="latest").orderBy("ts").collect()]
    assert (old, new) == ([0, 1, 2], [45, 46, 47])


def test_chunked_scan_shares_one_shuffle(spark, walk):
    out = I.rsi_ewm(frame(spark, walk)).select("symbol", "open_time", "rsi_14")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_warmup_form_is_close_to_exact(spark, walk):
    df = frame(spark, {"A": walk["A"]})
    cut = F.lit("2024-01-02 00:00:00").cast("timestamp")
    exact = I.momentum(df).where(F.col("open_time") >= cut)
    short = I.momentum_after_warmup(df.where(F.col("open_time") < cut), df.where(F.col("open_time") >= cut))
    np.testing.assert_allclose(values(short, "A", "rsi_14"), values(exact, "A", "rsi_14"), atol=1e-4)
    np.testing.assert_allclose(values(short, "A", "macd"), values(exact, "A", "macd"), atol=1e-2)


@pytest.mark.parametrize("holes", [[0], [0, 1, 2], [5], [7, 8, 9], [39], [0, 10, 11, 38, 39], list(range(8, 24))])
@pytest.mark.parametrize("chunk", [1, 8, 2048])
def test_null_values_are_stepped_over(spark, monkeypatch, holes, chunk):
    """A row without a value keeps its place and shows the mean before it, as pandas does when it ignores gaps."""
    monkeypatch.setattr(E, "CHUNK_STEPS", chunk)
    rng = np.random.default_rng(3)
    closes = pd.Series(100 + rng.normal(size=40).round(2))
    closes[holes] = np.nan
    start = dt.datetime(2024, 1, 1)
    rows = [("A", start + dt.timedelta(minutes=i), None if np.isnan(c) else float(c)) for i, c in enumerate(closes)]
    df = spark.createDataFrame(rows, "symbol string, open_time timestamp, close double")
    out = ewm(df, "symbol", "open_time", 60, [Mean("close", 9, "y"), Mean("close", 9, "up", "rise")])
    want = closes.ewm(span=9, adjust=False, ignore_na=True).mean()
    np.testing.assert_allclose(values(out, "A", "y"), want, rtol=1e-11)
    known = closes.dropna()
    rises = known.diff().clip(lower=0).ewm(span=9, adjust=False).mean().reindex(closes.index).ffill()
    np.testing.assert_allclose(values(out, "A", "up"), rises, rtol=1e-9, atol=1e-12)


ODD = [float("nan"), float("inf"), float("-inf"), None]


@pytest.mark.parametrize("holes", [[0], [0, 1, 20, 21, 59], [10], list(range(55, 60))])
@pytest.mark.parametrize("chunk", [1, 2048])
def test_nan_and_infinity_count_as_missing(spark, monkeypatch, tmp_path, holes, chunk):
    """Batch and stream go on behind a value that is no number, as pandas does when it ignores gaps."""
    from tickloom.streaming.indicators import MomentumStream

    monkeypatch.setattr(E, "CHUNK_STEPS", chunk)
    closes = pd.Series(100 + np.cumsum(np.random.default_rng(5).normal(size=60)).round(2))
    given = [ODD[k % 4] if k in holes else float(c) for k, c in enumerate(closes)]
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("A", start + dt.timedelta(minutes=k), c) for k, c in enumerate(given)], "symbol string, open_time timestamp, close double")
    closes[holes] = np.nan
    known = closes.dropna()
    moves = known.diff()
    gain, loss = (moves.clip(lower=0).ewm(span=14, adjust=False).mean(), (-moves).clip(lower=0).ewm(span=14, adjust=False).mean())
    rsi = (100 - 100 / (1 + gain / loss)).reindex(closes.index).ffill().fillna(0.0)
    line = known.ewm(span=12, adjust=False).mean() - known.ewm(span=26, adjust=False).mean()
    line = line.reindex(closes.index).ffill()
    out = I.momentum(df)
    np.testing.assert_allclose(values(out, "A", "rsi_14"), rsi, rtol=1e-9)
    np.testing.assert_allclose(values(out, "A", "macd"), line, rtol=1e-9, atol=1e-9)
    if chunk > 1:
        stream = MomentumStream(spark, str(tmp_path / "m"))
        rows = df.orderBy("open_time").collect()
        for batch, part in enumerate((rows[:11], rows[11:58], rows[58:])):
            stream(spark.createDataFrame(part, df.schema), batch)
        np.testing.assert_allclose(values(stream.rows(), "A", "rsi_14"), rsi, rtol=1e-9)


def test_more_rows_than_steps_raise(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("A", start + dt.timedelta(seconds=i), 1.0) for i in range(6000)]
    df = spark.createDataFrame(rows, "symbol string, open_time timestamp, close double")
    with pytest.raises(Exception, match="remove duplicates first"):
        ewm(df, "symbol", "open_time", 60, [Mean("close", 9, "y")]).collect()


def test_fold_is_linear(spark, monkeypatch):
    """Twenty thousand chunks of one symbol."""
    import time

    monkeypatch.setattr(E, "CHUNK_STEPS", 1)
    df = spark.range(20_000).select(
        F.lit("A").alias("symbol"), F.timestamp_seconds(F.col("id") * 60).alias("open_time"), (F.col("id") % 7).cast("double").alias("close")
    )
    start = time.monotonic()
    out = ewm(df, "symbol", "open_time", 60, [Mean("close", 9, "y")])
    want = pd.Series(np.arange(20_000) % 7).astype(float).ewm(span=9, adjust=False).mean()
    np.testing.assert_allclose(values(out, "A", "y"), want, rtol=1e-9)
    assert time.monotonic() - start < 15


def test_batch_delivered_twice(spark, tmp_path):
    """The same rows twice in one micro-batch count once; two versions of the carry stay."""
    from tickloom.streaming.indicators import MomentumStream

    rng = np.random.default_rng(11)
    closes = 100 + np.cumsum(rng.normal(size=50)).round(2)
    df = frame(spark, {"A": closes})
    stream = MomentumStream(spark, str(tmp_path / "m"))
    rows = df.orderBy("open_time").collect()
    for batch, part in enumerate((rows[:20], rows[20:35], rows[35:])):
        new = spark.createDataFrame(part, df.schema)
        stream(new.unionByName(new), batch)
    np.testing.assert_allclose(values(stream.rows(), "A", "rsi_14"), pandas_rsi(pd.Series(closes)), rtol=1e-9, atol=1e-9)
    assert sorted(p.name for p in (tmp_path / "m" / "carry").iterdir()) == ["v1", "v2"]
