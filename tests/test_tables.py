"""Stored tables: marks, exactly-once upserts, late rows, buckets, roll-ups, interval joins, set-aside messages, table functions."""

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from tickloom.functions.tables import register_candle_tool, register_news_tool, register_ticker_tool
from tickloom.operators import load
from tickloom.operators.candles import candles
from tickloom.operators.intervals import interval_join
from tickloom.operators.rollup import Pyramid
from tickloom.sources import bucketed, marked
from tickloom.sources.candles import judged_klines
from tickloom.sources.messages import judged_depth
from tickloom.streaming.sinks import read_new_files, run_batches
from tickloom.streaming.tables import LateGuard, MonthlyUpsert

START = dt.datetime(2024, 1, 1)


def candle_rows(spark, n, symbols=("A", "B"), step=60, seed=1):
    rng = random.Random(seed)
    rows = [(s, START + dt.timedelta(seconds=step * k), *(rng.randint(1, 99) / 4 for _ in range(5))) for s in symbols for k in range(n)]
    return spark.createDataFrame(rows, "symbol string, open_time timestamp, open double, high double, low double, close double, volume double")


def monthly(rows):
    return rows.withColumn("month", F.date_format("open_time", "yyyy-MM"))


def same(a, b):
    return sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- marks ---------------------------------------------------------------------
def test_a_load_reads_marks_only(spark, tmp_path):
    path, rows = str(tmp_path / "t"), monthly(candle_rows(spark, 60 * 24, step=3600))
    first = rows.where(F.col("open_time") < START + dt.timedelta(days=40))
    assert marked.load_into(first, path, ["symbol"], "open_time") == 1
    fresh = marked.fresh_rows(rows, path, ["symbol"], "open_time")
    assert fresh.inputFiles() and all("/marks/" in f for f in fresh.inputFiles())
    assert "/rows" not in plan_of(fresh)
    assert [marked.load_into(rows, path, ["symbol"], "open_time") for _ in range(2)] == [2, 2]
    stored = marked.read_loaded(spark, path, rows.schema)
    assert same(stored, rows)
    assert {r["symbol"]: r["open_time"] for r in marked.read_marks(spark, path).collect()} == dict.fromkeys("AB", START + dt.timedelta(hours=60 * 24 - 1))
    february = stored.where(F.col("month") == "2024-02")
    assert february.count() and "PartitionFilters: [" in plan_of(february) and "2024-02" in plan_of(february).split("PartitionFilters: ")[1].split("]")[0]


def test_a_load_that_broke_off_is_done_again(spark, tmp_path):
    """Rows without their marks are read by nobody and overwritten by the next load."""
    path, rows = str(tmp_path / "t"), monthly(candle_rows(spark, 48, step=3600))
    marked.load_into(rows.where("hour(open_time) < 5"), path, ["symbol"], "open_time")
    before = marked.read_loaded(spark, path, rows.schema).count()
    rows.write.partitionBy("month").parquet(f"{path}/rows/load=2")
    (tmp_path / "t/marks/2-from-1").mkdir()  # marks begun, not complete
    assert marked.read_loaded(spark, path, rows.schema).count() == before
    late_and_new = rows.where(F.col("open_time") > START + dt.timedelta(hours=30))
    assert marked.load_into(late_and_new, path, ["symbol"], "open_time") == 2
    assert same(marked.read_loaded(spark, path, rows.schema), rows.where("hour(open_time) < 5").unionByName(late_and_new))


def test_folding_loads_keeps_rows_and_marks(spark, tmp_path):
    path, rows = str(tmp_path / "t"), monthly(candle_rows(spark, 40 * 24, step=3600))
    for day in (5, 20, 40):
        marked.load_into(rows.where(F.col("open_time") < START + dt.timedelta(days=day)), path, [], "open_time")
    assert marked.fold_loads(spark, path, rows.schema) == 4
    assert sorted(p.name for p in (tmp_path / "t/rows").iterdir() if "=" in p.name) == ["load=4"]
    assert same(marked.read_loaded(spark, path, rows.schema), rows)
    assert marked.load_into(rows, path, [], "open_time") == 4
    later = monthly(candle_rows(spark, 1)).withColumn("open_time", F.lit(dt.datetime(2024, 5, 1))).withColumn("month", F.lit("2024-05"))
    assert marked.load_into(later, path, [], "open_time") == 5
    assert marked.read_loaded(spark, path, rows.schema).count() == rows.count() + 2
    assert marked.read_loaded(spark, str(tmp_path / "none"), rows.schema).count() == 0
    assert marked.load_into(rows.limit(0), str(tmp_path / "none"), ["symbol"], "open_time") == 0


# --- exactly-once upserts --------------------------------------------------------
KEYED = "symbol string, at timestamp, v long, version long, month string"


def versions(spark, *rows):
    return spark.createDataFrame([(s, dt.datetime(2024, m, 1), v, n, f"2024-{m:02d}") for s, m, v, n in rows], KEYED)


class Breaking(MonthlyUpsert):
    """Fails once at a given point of the batch it is told."""

    def __init__(self, *args, point: str):
        super().__init__(*args)
        self.point, self.merges = point, 0

    def merge(self, batch, batch_id):
        self.merges += 1
        super().merge(batch, batch_id)
        self.stop("merged")

    def replace(self, batch_id):
        if self.point == "half":  # one of the months is gone, the other not yet replaced
            shutil.rmtree(f"{self.path}/rows/month=2024-01")
            self.stop("half")
        super().replace(batch_id)
        self.stop("replaced")

    def stop(self, point):
        if self.point == point:
            self.point = ""
            raise RuntimeError("lost")


@pytest.mark.parametrize("point", ["merged", "half", "replaced"])
def test_repeated_batch_changes_nothing(spark, tmp_path, point):
    root = str(tmp_path)
    first = versions(spark, ("A", 1, 1, 5), ("A", 2, 2, 5), ("B", 1, 3, 5), ("C", 3, 4, 5))
    second = versions(spark, ("A", 1, 10, 4), ("A", 1, 11, 7), ("A", 2, 20, 6), ("D", 1, 30, 1), ("D", 1, 31, 2))
    args = (spark, f"{root}/table", first.schema, ["symbol", "at"], ["version"])

    def run(rows, handler, fails=False):
        if rows is not None:
            rows.write.mode("append").parquet(f"{root}/in")
        stream = read_new_files(spark, f"{root}/in", first.schema)
        if fails:
            with pytest.raises(Exception, match="lost"):
                run_batches(stream, handler, f"{root}/state")
        else:
            run_batches(stream, handler, f"{root}/state")

    run(first, MonthlyUpsert(*args))
    breaking = Breaking(*args, point=point)
    run(second, breaking, fails=True)
    run(None, breaking)  # the same batch again
    assert breaking.merges == 1
    out = sorted((r["symbol"], r["month"], r["v"]) for r in breaking.rows().collect())
    assert out == [("A", "2024-01", 11), ("A", "2024-02", 20), ("B", "2024-01", 3), ("C", "2024-03", 4), ("D", "2024-01", 31)]
    breaking(second.withColumn("v", F.lit(99).cast("long")), 1)  # in the ledger: skipped
    assert sorted((r["symbol"], r["month"], r["v"]) for r in breaking.rows().collect()) == out
    assert not list((tmp_path / "table/merged").glob("batch=*"))


def test_late_rows_are_set_aside_and_counted(spark, tmp_path):
    rows = [(k, None if k == 7 else START + dt.timedelta(hours=h)) for k, h in enumerate([0, 5, 10, 10, 30, 3, 21, 0, 19, 60])]
    schema = "id long, ts timestamp"
    parts = [spark.createDataFrame(rows[a:b], schema) for a, b in ((0, 4), (4, 7), (7, 10))]
    guard = LateGuard(spark, str(tmp_path / "t"), parts[0].schema, "ts", 6 * 3600)
    for _ in range(2):  # a repeated batch overwrites its own rows
        for k, part in enumerate(parts):
            guard(part, k)
    assert sorted(r["id"] for r in guard.rows().collect()) == [0, 1, 2, 3, 4, 6, 9]
    assert sorted(r["id"] for r in guard.rows(guard.LATE).collect()) == [5, 8]
    assert [r["id"] for r in guard.rows(guard.TIMELESS).collect()] == [7]
    counts = [(r["batch"], r["stored"], r["late"], r["timeless"]) for r in guard.ledger().orderBy("batch").collect()]
    assert counts == [(0, 4, 0, 0), (1, 2, 1, 0), (2, 1, 1, 1)]
    assert guard.outcomes().count() == len(rows)


# --- buckets ---------------------------------------------------------------------
def test_bucketed_tables_need_no_exchange(spark, tmp_path):
    rows = spark.range(3000).select((F.col("id") % 37).alias("k"), (F.col("id") % 500).alias("t"), F.col("id").alias("v"))
    for name in ("left_b", "right_b"):
        bucketed.write_bucketed(rows, name, str(tmp_path / name), ["k", "t"], ["v"], buckets=4)
    bucketed.write_bucketed(rows.withColumn("v", F.col("v") + 9000), "left_b", str(tmp_path / "left_b"), ["k", "t"], ["v"], buckets=4, mode="append")
    newest = bucketed.latest_bucketed(spark, "left_b", ["k", "t"], ["v"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = newest.join(spark.table("right_b").groupBy("k", "t").agg(F.max("v").alias("w")), ["k", "t"])
        got = joined.collect()
        for df in (newest, joined):
            df.collect()
            assert "Exchange" not in plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = {(r["k"], r["t"]): r["v"] for r in rows.groupBy("k", "t").agg(F.max("v").alias("v")).collect()}
    assert {(r["k"], r["t"]): (r["v"] - 9000, r["w"]) for r in got} == {key: (v, v) for key, v in want.items()}
    spark.sql("DROP TABLE left_b")
    spark.sql("DROP TABLE right_b")


# --- roll-ups --------------------------------------------------------------------
def test_rollup_equals_candles_before_and_after_late_rows(spark, tmp_path):
    rows = candle_rows(spark, 4 * 1440)
    late = F.pmod(F.xxhash64("symbol", "open_time"), F.lit(5)) == 0
    early = rows.where(~late)
    pyramid = Pyramid(spark, str(tmp_path / "p"))
    pyramid.add(early, "a")
    bounds = [(START + dt.timedelta(minutes=m), START + dt.timedelta(minutes=n)) for m, n in ((0, 5759), (61, 4003), (1440, 2879), (1500, 1501), (3000, 100))]
    for size in (60, 900, 3600, 14400, 86400, 604800):
        assert same(pyramid.candles(size), candles(early, size)), size
    pyramid.add(rows.where(late), "b")
    pyramid.add(rows.where(late), "b")
    for size in (300, 3600, 43200, 86400, 604800):
        assert same(pyramid.candles(size), candles(rows, size)), size
        for low, high in bounds:
            assert same(pyramid.candles(size, low, high), candles(rows.where(F.col("open_time").between(low, high)), size)), (size, low)
    with pytest.raises(ValueError, match="multiple"):
        pyramid.candles(90)


def test_wide_charts_read_the_widest_level(spark, tmp_path):
    pyramid = Pyramid(spark, str(tmp_path / "p"))
    pyramid.add(candle_rows(spark, 45 * 24, step=3600), "a")
    assert all("level=86400" in f for f in pyramid.candles(604800).inputFiles())
    assert all("level=3600" in f for f in pyramid.candles(14400).inputFiles())
    part = pyramid.candles(86400, dt.datetime(2024, 2, 2), dt.datetime(2024, 2, 9))
    part.collect()
    filters = [x.split("]")[0] for x in plan_of(part).split("PartitionFilters: [")[1:]]
    assert filters and all("month" in f and "2024-02" in f for f in filters)


# --- interval joins ----------------------------------------------------------------
def test_interval_join_equals_comparing_all(spark):
    rng = random.Random(2)
    at = lambda m: None if m is None else START + dt.timedelta(seconds=m)
    points = [(rng.choice("AAAAAB"), k, rng.choice([None, *range(0, 9000, 7)])) for k in range(400)] + [("A", 999, 3600)]
    ranges = [(rng.choice("AAAB"), k, lo, None if lo is None else lo + rng.randint(-500, 4000)) for k, lo in enumerate(rng.choices([None, *range(0, 9000, 11)], k=150))]
    ranges += [("A", 999, 3600, 3600), ("A", 999, 3600, 3600), (None, 5, 0, 9000)]
    left = spark.createDataFrame([(s, k, at(m)) for s, k, m in points], "symbol string, point int, at timestamp")
    right = spark.createDataFrame([(s, k, at(a), at(b)) for s, k, a, b in ranges], "symbol string, range int, lo timestamp, hi timestamp")
    out = interval_join(left, right, ["symbol"], "at", "lo", "hi", 600)
    want = sorted((k, r) for s, k, m in points for z, r, a, b in ranges if s == z and None not in (m, a, b) and a <= m <= b)
    assert sorted((r["point"], r["range"]) for r in out.collect()) == want
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)


def test_hot_key_is_spread_over_bins(spark):
    points = spark.range(20000).select(F.lit("A").alias("symbol"), F.timestamp_seconds(F.col("id") * 60).alias("at"))
    ranges = spark.range(500).select(F.lit("A").alias("symbol"), F.timestamp_seconds(F.col("id") * 2400).alias("lo"), F.timestamp_seconds(F.col("id") * 2400 + 600).alias("hi"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = interval_join(points, ranges, ["symbol"], "at", "lo", "hi", 3600).withColumn("task", F.spark_partition_id())
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert out.select("task").distinct().count() == 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# --- audits, messages, functions -------------------------------------------------------
def test_sketches_merge(spark):
    rows = spark.range(60000).select((F.col("id") % 7919).cast("string").alias("k"), F.timestamp_seconds("id").alias("t"), (F.col("id") % 12).alias("month"))
    parts = load.audit_parts(rows, "k", "t", "month")
    merged = load.merged_audit(parts).first()
    assert merged["n_rows"] == 60000 and abs(merged["n_symbols"] - 7919) < 0.05 * 7919
    twice = load.merged_audit(parts.unionByName(parts)).first()
    assert twice["n_symbols"] == merged["n_symbols"]
    assert load.merged_audit(parts.limit(0)).first()["n_rows"] is None


def test_broken_messages_keep_a_row_with_the_reason(spark):
    bodies = ['{"bids": [["1", "2"]], "asks": []}', '{"asks": null, "bids": null}', "{}", "[1]", "x", "", None, '{"bids": [["1"', '{"bids": []}']
    out = judged_depth(spark.createDataFrame([("S", "t", b) for b in bodies], "symbol string, timestamp string, body string"), "body")
    got = {(r["body"], r["reason"]) for r in out.collect() if r["reason"]}
    assert got == {(bodies[1], "no book"), ("{}", "no book"), ("[1]", "unreadable"), ("x", "unreadable"), ("", "unreadable"), (None, "no message"), (bodies[7], "unreadable")}
    assert sorted(len(r["bids"]) for r in out.where("reason IS NULL").collect()) == [0, 1]
    row = '["1704067200000", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11"]'
    pages = [f"[{row}, [\"1\"], {row.replace('1704067200000', 'x')}]", "[]", "nonsense", None, '{"code": 1}']
    out = judged_klines(spark.createDataFrame([("S", p) for p in pages], "symbol string, page string"), "page").collect()
    assert sorted(str(r["reason"]) for r in out) == ["None", "bad candle", "bad candle", "empty page", "no message", "unreadable", "unreadable"]
    assert [r["open_time"] for r in out if r["reason"] is None] == [1704067200000]
    assert '["1"]' in {r["body"] for r in out}


def test_news_index_reads_the_months_asked_for(spark, tmp_path):
    from tickloom.sources import newsindex

    def articles(*days):
        rows = [(f"a{d:03d}", START + dt.timedelta(days=d), START + dt.timedelta(days=d), f"title {d}", "text", "src", ["A", "B"] if d % 3 else ["A"]) for d in days]
        return spark.createDataFrame(rows, "article_id string, published_at timestamp, extracted_at timestamp, title string, description string, source_name string, symbols array<string>")

    path = str(tmp_path / "i")
    newsindex.append_index(articles(*range(0, 80)), path, "a")
    for _ in range(2):
        newsindex.append_index(articles(*range(75, 100), 3), path, "b")  # some again, one late
    index = newsindex.read_index(spark, path)
    got = newsindex.newest_from_index(index, 20, n=5)
    ranks = sorted((r["symbol"], r["rank"], r["article_id"]) for r in got.collect())
    want = {"A": [99, 98, 97, 96, 95], "B": [98, 97, 95, 94, 92]}
    assert ranks == sorted((s, k + 1, f"a{d:03d}") for s, days in want.items() for k, d in enumerate(days))
    filters = [x.split("]")[0] for x in plan_of(got).split("PartitionFilters: [")[1:]]
    assert filters and any("month" in f for f in filters)
    assert [r["article_id"] for r in newsindex.news_from_index(index, "B", 400, n=100).orderBy("rank").collect()] == [f"a{d:03d}" for d in range(99, -1, -1) if d % 3]


def test_lookbacks_of_ticker_and_books_prune_by_month(spark, tmp_path):
    from tickloom.operators.orderbook import ob_summary, ob_trend
    from tickloom.operators.ticker import spread_daily, ticker_trend

    rows = spark.range(0, 24 * 100).select(
        F.lit("A").alias("symbol"), F.timestamp_seconds(F.col("id") * 3600 + 1704067200).alias("snapshot_time"),
        *[(F.col("id") % 13).cast("double").alias(c) for c in ("spread_pct", "price_change_pct", "volume_24h", "trade_count", "obi", "depth_bid_volume", "depth_ask_volume")],
    ).withColumn("timestamp", F.col("snapshot_time"))
    rows.withColumn("month", F.date_format("timestamp", "yyyy-MM")).write.partitionBy("month").parquet(str(tmp_path / "t"))
    stored = spark.read.schema(rows.withColumn("month", F.lit("x")).schema).parquet(str(tmp_path / "t"))
    for make in (lambda m: spread_daily(stored, 5, month=m), lambda m: ticker_trend(stored, "day", 5, month=m), lambda m: ob_trend(stored, "day", 5, month=m), lambda m: ob_summary(stored, 5, month=m)):
        pruned = make("month")
        assert same(pruned, make(None))
        assert any("month" in x.split("]")[0] for x in plan_of(pruned).split("PartitionFilters: [")[1:])


def test_hot_session_lies_on_several_tasks(spark):
    from tickloom.operators.chat import chat_history

    rows = spark.range(9000).select(F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("session"), F.col("id").alias("turn"))
    out = chat_history(rows.repartition(5), "session", ["turn"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = out.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["task"] for r in got if r["session"] == 7}) >= 4
    assert [(r["session"], r["turn"]) for r in got] == sorted((r["session"], r["turn"]) for r in got)


def test_table_function_takes_names_and_defaults(spark):
    register_candle_tool(spark, candle_rows(spark, 2000), "tool_test")
    ask = lambda **a: spark.sql("SELECT * FROM tool_test(" + ", ".join(f"{k} => :{k}" for k in a) + ")", args=a).collect()
    medium = ask(wanted="A", preset="medium")
    assert len(medium) == 1 and medium[0]["report"].count("\n") == 8
    assert ask(wanted="A") == medium == ask(wanted="A", preset="no such")
    assert ask(wanted="A", preset="short")[0]["report"].count("\n") == 33
    assert ask(wanted="nobody", preset="long") == []


def test_tools_answer_for_any_symbol(spark):
    """One row for every symbol that is asked for: with rows, listed without rows, not listed; nulls read 0."""
    rows = [("A", START, 1.5, 2e6, 0.25), ("A", START + dt.timedelta(days=1), -2.5, 3e6, 0.5), ("N", START, None, None, float("nan"))]
    ticks = spark.createDataFrame(rows, "symbol string, snapshot_time timestamp, price_change_pct double, volume_24h double, spread_pct double")
    dim = spark.createDataFrame([("A",), ("N",), ("LISTED",), ("A",)], "symbol string")
    register_ticker_tool(spark, ticks.withColumn("trade_count", F.lit(1)), dim, "ticker_test")
    ask = lambda tool, s, p="medium": [tuple(r) for r in spark.sql(f"SELECT * FROM {tool}(wanted => :s, preset => :p)", args={"s": s, "p": p}).collect()]
    tail = "\n\n--- Latest 24h snapshot ---\nPrice change: {}%\nVolume 24h: {}\nBid-ask spread: {}%"
    lines = "2024-01-01 Vol:2,000,000 Spread:0.2500% PriceChg:+1.50%\n2024-01-02 Vol:3,000,000 Spread:0.5000% PriceChg:-2.50%"
    assert ask("ticker_test", "A") == [("A", lines + tail.format("-2.50", "3,000,000", "0.5000"))]
    nothing = "(No ticker trend data available)" + tail.format("+0.00", "0", "0.0000")
    for s in ("LISTED", "nobody", "it's"):
        assert ask("ticker_test", s, "long") == [(s, nothing)]
    assert ask("ticker_test", "N")[0][1] == "2024-01-01 Vol:0 Spread:0.0000% PriceChg:+0.00%" + tail.format("+0.00", "0", "0.0000")

    news = "article_id string, published_at timestamp, symbols array<string>, title string, description string, source_name string"
    register_news_tool(spark, spark.createDataFrame([("1", START, ["A"], "T", None, "")], news), dim, "news_test")
    assert ask("news_test", "A", "short") == [("A", "[2024-01-01 00:00] T")]
    assert ask("news_test", "nobody") == [("nobody", "(No recent news articles found for this symbol)")]


def test_a_tool_reads_its_symbol_only(spark, tmp_path):
    """The symbol asked for, and the null one, reach the scan of the stored table."""
    rows = [(s, START, 1.0, 1.0, 1.0, 1) for s in "ABC"]
    ticks = spark.createDataFrame(rows, "symbol string, snapshot_time timestamp, price_change_pct double, volume_24h double, spread_pct double, trade_count int")
    ticks.write.parquet(str(tmp_path / "t"))
    register_ticker_tool(spark, spark.read.parquet(str(tmp_path / "t")), ticks.select("symbol"), "ticker_scan_test", START)
    plan = spark.sql("SELECT * FROM ticker_scan_test(wanted => 'B')")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(symbol,B)" in plan and plan.count("FileScan parquet") <= 2
