"""Incremental loading, lake layout and gaps."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom import session
from tickloom.operators import load
from tickloom.sources import candles as candle_source
from tickloom.sources import lake


def T(text):
    return dt.datetime.fromisoformat(text)


def rows(spark, *items):
    return spark.createDataFrame([(s, T(t), float(v)) for s, t, v in items], "symbol string, ts timestamp, v double")


def got(df):
    return sorted((r["symbol"], str(r["ts"]), r["v"]) for r in df.collect())


def test_incremental_is_strict_and_repeatable(spark):
    loaded = rows(spark, ("A", "2024-01-02", 1))
    new = rows(spark, ("A", "2024-01-01", 1), ("A", "2024-01-02", 2), ("A", "2024-01-03", 3), ("B", "2024-01-01", 4))
    fresh = load.incremental(new, loaded, ["symbol"], "ts")
    assert got(fresh) == [("A", "2024-01-03 00:00:00", 3.0), ("B", "2024-01-01 00:00:00", 4.0)]
    assert load.incremental(new, loaded.unionByName(fresh), ["symbol"], "ts").count() == 0


def test_incremental_global_on_an_empty_table(spark):
    new = rows(spark, ("A", "2024-01-01", 1))
    assert load.incremental(new, new.limit(0), [], "ts").count() == 1
    assert load.incremental(new, new, [], "ts").count() == 0


def test_resent_book_row_is_not_loaded_again(spark):
    old = spark.createDataFrame([("A", T("2024-01-01 00:00:05"))], "symbol string, timestamp timestamp")
    new = spark.createDataFrame([("A", T("2024-01-01 00:00:05.900")), ("A", T("2024-01-01 00:00:06.100"))], "symbol string, timestamp timestamp")
    assert [str(r["timestamp"]) for r in load.load_order_book(new, old).collect()] == ["2024-01-01 00:00:06"]


def test_late_policies(spark):
    loaded = rows(spark, ("A", "2024-01-10", 1), ("A", "2024-02-10", 1))
    new = rows(spark, ("A", "2024-01-05", 2), ("A", "2024-01-10", 1), ("A", "2024-02-10", 1), ("A", "2024-02-11", 3))
    assert got(load.incremental(new, loaded, ["symbol"], "ts")) == [("A", "2024-02-11 00:00:00", 3.0)]
    days = [t[:10] for _, t, _ in got(load.incremental(new, loaded, ["symbol"], "ts", "recompute_month"))]
    assert days == ["2024-01-05", "2024-01-10", "2024-02-11"]
    assert len(got(load.late_rows(new, loaded, ["symbol"], "ts"))) == 3
    with pytest.raises(ValueError):
        load.incremental(new, loaded, ["symbol"], "ts", "other")


def test_upsert_keeps_last_and_is_idempotent(spark):
    old = rows(spark, ("A", "2024-01-01", 1), ("A", "2024-01-02", 1))
    new = rows(spark, ("A", "2024-01-02", 2)).withColumn("extra", F.lit("x"))
    once = load.upsert(old, new, ["symbol", "ts"])
    twice = load.upsert(once, new, ["symbol", "ts"])
    assert got(once) == got(twice) == [("A", "2024-01-01 00:00:00", 1.0), ("A", "2024-01-02 00:00:00", 2.0)]
    assert once.columns[-1] == "extra"


def test_insert_new_ignores_null_keys(spark):
    have = spark.createDataFrame([("A",), (None,)], "symbol string")
    assert [r[0] for r in load.insert_new(have, spark.createDataFrame([("A",), ("B",)], "symbol string"), "symbol").collect()] == ["B"]


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert sorted(str(r[0]) for r in load.delete_where(df, F.col("k") == 1).collect()) == ["2", "None"]


def test_gap_ranges(spark):
    as_of = F.lit("2024-01-10 10:00:30").cast("timestamp")
    dim = spark.createDataFrame(
        [("NEW", "TRADING", None), ("OLD", None, None), ("OK", "TRADING", None), ("GONE", "BREAK", "2024-01-05"), ("DONE", "BREAK", "2024-01-05")],
        "symbol string, status string, break_date string",
    )
    have = rows(spark, ("OLD", "2024-01-10 09:00", 1), ("OK", "2024-01-10 09:59", 1), ("GONE", "2024-01-04 23:00", 1), ("DONE", "2024-01-05 00:00", 1))
    out = {r["symbol"]: (str(r["fetch_from"]), str(r["fetch_to"]), r["bootstrap"]) for r in load.gap_ranges(dim, have, "ts", as_of).collect()}
    assert out == {
        "NEW": ("None", "2024-01-10 09:59:00", True),
        "OLD": ("2024-01-10 09:01:00", "2024-01-10 09:59:00", False),
        "GONE": ("2024-01-04 23:01:00", "2024-01-05 00:00:00", False),
    }


def test_missing_candles_across_midnight(spark):
    df = rows(spark, ("A", "2024-01-01 23:57", 1), ("A", "2024-01-02 00:01", 1), ("A", "2024-01-01 23:59", 1), ("B", "2024-01-01 00:00", 1))
    out = sorted((r["symbol"], str(r["open_time"])) for r in load.missing_candles(df, "ts").collect())
    assert out == [("A", "2024-01-01 23:58:00"), ("A", "2024-01-02 00:00:00")]


def test_warmup_takes_the_last_rows(spark):
    old = rows(spark, *[("A", f"2024-01-{d:02d}", d) for d in range(1, 10)])
    out = load.with_warmup(old, rows(spark, ("A", "2024-01-20", 20)), ["symbol"], "ts", rows=3)
    assert sorted((r["v"], r["is_context"]) for r in out.collect()) == [(7.0, True), (8.0, True), (9.0, True), (20.0, False)]


def test_month_from_the_first_known_column(spark):
    ms = spark.createDataFrame([(1777507200000,), (1777593600000,)], "open_time bigint")
    assert sorted(r["month"] for r in lake.derive_month(ms).collect()) == ["2026-04", "2026-05"]
    both = spark.createDataFrame([(T("2024-02-01"), T("2024-03-01"))], "timestamp timestamp, extracted_at timestamp")
    assert lake.derive_month(both).first()["month"] == "2024-02"
    plain = lake.derive_month(spark.range(1), F.lit("2024-07-05").cast("timestamp"))
    assert plain.first()["month"] == "2024-07"


def test_null_time_is_an_error(spark):
    df = spark.createDataFrame([(None,)], "open_time timestamp")
    with pytest.raises(Exception, match="null timestamp"):
        lake.derive_month(df).collect()


def test_discover_months(spark):
    names = ["k/A/2026-04.csv", "k/A/2026-05_delta_1779531739000.parquet", "k/A/2026-06_delta_1_ab.parquet", "k/A/_SUCCESS",
             "k/A/latest.parquet", "k/A/2026-13.parquet", "k/A/not-a-month_delta_1.parquet", "k/A/2026-07.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "key string")
    assert sorted(r[0] for r in lake.discover_months(df, "key", ".csv").collect()) == ["2026-04", "2026-05", "2026-06"]
    assert sorted(r[0] for r in lake.discover_months(df, "key").collect()) == ["2026-05", "2026-06", "2026-07"]


def test_deltas_by_write_time_as_plain_files(spark, tmp_path):
    for name, v in (("1000", 1), ("2000_ab12", 2), ("bad", 3)):
        pd.DataFrame({"symbol": ["A"], "v": [v]}).to_parquet(tmp_path / f"2026-05_delta_{name}.parquet")
    pd.DataFrame({"symbol": ["A"], "v": [9]}).to_parquet(tmp_path / "2026-05.parquet")

    def seen(since):
        return sorted(r["v"] for r in lake.read_deltas(spark, [str(tmp_path)], since).collect())

    assert (seen(None), seen(1500), seen(2000)) == ([1, 2, 3], [2], [])
    base = lake.scan_base_delta(spark, [str(tmp_path)], base_parquet=str(tmp_path / "2026-05.parquet"))
    assert sorted(r["v"] for r in base.collect()) == [1, 2, 3, 9]
    assert lake.scan_base_delta(spark, [str(tmp_path)], base_parquet=str(tmp_path / "2026-05.parquet"), since_ms=1500).count() == 1


def test_append_then_upsert_months(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "symbol string, timestamp timestamp, v double"
    old = spark.createDataFrame([("A", T("2024-01-01"), 1.0), ("A", T("2024-02-01"), 1.0), ("B", T("2024-02-01"), 1.0)], schema)
    lake.append_delta(old, path)
    assert {d for d in os.listdir(path) if "=" in d} == {"symbol=A", "symbol=B"}
    fix = lake.derive_month(spark.createDataFrame([("A", T("2024-02-01"), 5.0), ("A", T("2024-02-02"), 6.0)], schema))
    for _ in range(2):
        lake.upsert_months(fix, path, ["timestamp"], ["symbol", "month"])
    out = spark.read.parquet(path).collect()
    assert sorted((r["symbol"], str(r["timestamp"])[:10], r["v"]) for r in out) == [
        ("A", "2024-01-01", 1.0), ("A", "2024-02-01", 5.0), ("A", "2024-02-02", 6.0), ("B", "2024-02-01", 1.0)]


def test_bulk_csv(spark, tmp_path):
    line = "{t},42000,42500,41800,42300,100.5,{c},4230000,500,60.3,2538000,0\n"
    for symbol, scale in (("BTCUSDT", 1), ("ETHUSDT", 1000)):
        (tmp_path / symbol).mkdir()
        (tmp_path / symbol / f"{symbol}-1m-2024-01.csv").write_text(line.format(t=1704067200000 * scale, c=1704067259999 * scale))
    out = candle_source.scan_klines_csv(spark, str(tmp_path / "*")).orderBy("symbol").collect()
    assert [(r["symbol"], r["open_time"], r["close_time"], r["taker_buy_quote"]) for r in out] == [
        (s, 1704067200000, 1704067259999, 2538000.0) for s in ("BTCUSDT", "ETHUSDT")]


def test_kline_json_bad_numbers(spark):
    body = '[[1704067200000,"42000","x","41800","42300","100.5",1704067259999,"4230000",500,"60.3","2538000","0"]]'
    row = candle_source.parse_kline_json(spark.createDataFrame([("A", body)], "symbol string, body string"), "body").first()
    assert (row["open_time"], row["open"], row["high"], row["trade_count"]) == (1704067200000, 42000.0, None, 500)


def test_checkpoint_root_comes_from_the_session(spark):
    assert session.checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
