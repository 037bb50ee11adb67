"""Partition pruning on a table of months, and what an upsert reads and writes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.operators import load
from tickloom.operators.candles import candles, candles_between
from tickloom.operators.forecast import forecast_overlay
from tickloom.operators.heatmap import rsi_heatmap
from tickloom.sources import lake


@pytest.fixture(scope="module")
def lake_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "klines")
    rows = spark.range(0, 24 * 150).select(
        F.lit("A").alias("symbol"), F.timestamp_seconds(F.col("id") * 3600 + 1704067200).alias("open_time"),
        *[(F.col("id") % 17).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume", "quote_volume")],
    )
    lake.append_delta(rows, path)
    return path


def months_read(df):
    """Values of the partition column among the files that the plan's scan picks."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.split("PartitionFilters: ")[1:]]
    return [x[: x.index("]")] for x in lines]


def test_every_range_prunes(spark, lake_path):
    klines = spark.read.parquet(lake_path).withColumn("month", F.col("month").cast("string"))
    klines = spark.read.schema(klines.schema).parquet(lake_path)
    start, end = dt.datetime(2024, 3, 2), dt.datetime(2024, 3, 9)
    ticker = spark.createDataFrame([("A", end, 1.0, 1.0)], "symbol string, snapshot_time timestamp, quote_volume_24h double, price_change_pct double")
    dim = spark.createDataFrame([("A", "A", "TRADING")], "symbol string, base_asset string, status string")
    forecasts = spark.createDataFrame([("A", start)], "symbol string, predicted_at timestamp")
    frames = {
        "lookback": candles(klines, 3600, lookback_days=5, as_of=end, month="month"),
        "newest": candles(klines, 3600, lookback_days=5, month="month"),
        "between": candles_between(klines, start, end, month="month"),
        "month": times.in_month(klines, "open_time", "2024-02", "month"),
        "heatmap": rsi_heatmap(klines, ticker, dim, month="month"),
        "forecast": forecast_overlay(klines, forecasts, month="month"),
    }
    for name, df in frames.items():
        assert any("month" in f for f in months_read(df)), name
    assert frames["newest"].count() == candles(klines, 3600, lookback_days=5).count()
    assert frames["between"].count() == candles_between(klines, start, end).count()
    assert frames["month"].count() == 29 * 24
    assert frames["forecast"].count() == forecast_overlay(klines, forecasts).count()


def test_upsert_touches_its_months_and_splits_them(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(6000).select(
        F.lit("HOT").alias("symbol"), F.col("id").alias("at"), F.lit(1.0).alias("v"),
        F.when(F.col("id") < 5000, "2024-01").otherwise("2024-02").alias("month"),
    )
    rows.write.partitionBy("month").parquet(path)
    before = {f.name for f in (tmp_path / "t" / "month=2024-02").iterdir()}
    fixed = rows.where("month = '2024-01'").withColumn("v", F.lit(2.0))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else Spark joins partitions this small
    try:
        lake.upsert_months(fixed, path, ["symbol", "at"], ["month"], months=["2024-01"], schema=rows.schema)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    out = spark.read.schema(rows.schema).parquet(path)
    assert {(r.month, r.n, r.s) for r in out.groupBy("month").agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()} == {
        ("2024-01", 5000, 10000.0), ("2024-02", 1000, 1000.0)
    }
    assert {f.name for f in (tmp_path / "t" / "month=2024-02").iterdir()} == before
    assert len([f for f in (tmp_path / "t" / "month=2024-01").iterdir() if f.suffix == ".parquet"]) > 1


def test_marks_replace_the_scan(spark):
    loaded = spark.createDataFrame([("A", 5), ("B", 7)], "symbol string, t int")
    new = spark.createDataFrame([("A", 5), ("A", 6), ("B", 7), ("C", 1)], "symbol string, t int")
    marks = load.watermarks(loaded, ["symbol"], "t", "t")
    fresh = load.incremental(new, loaded, ["symbol"], "t", marks=marks)
    assert sorted(map(tuple, fresh.collect())) == [("A", 6), ("C", 1)]
    after = load.advance_marks(marks, fresh, ["symbol"], "t")
    assert sorted(map(tuple, after.collect())) == [("A", 6), ("B", 7), ("C", 1)]
    assert load.incremental(new, loaded, ["symbol"], "t", marks=after).count() == 0


def test_upsert_rewrites_changed_months_only(spark, tmp_path):
    """A repeated delivery writes nothing; a corrected row, a new column with values and a removed copy do."""
    path = str(tmp_path / "t")
    rows = [("A", m, d, float(d)) for m in ("2024-01", "2024-02", "2024-03") for d in range(5)]
    stored = spark.createDataFrame(rows, "symbol string, month string, day int, close double")
    stored.write.partitionBy("month").parquet(path)
    seen = lambda: {m: sorted(p.name for p in (tmp_path / "t" / f"month={m}").glob("*.parquet")) for m in ("2024-01", "2024-02", "2024-03")}
    first = seen()
    put = lambda df: lake.upsert_months(df, path, ["symbol", "day"], ["month"])
    put(stored.where("month <> '2024-03'"))
    assert seen() == first
    put(stored.where("month <> '2024-03'").withColumn("close", F.expr("if(month = '2024-02' AND day = 3, 9.5, close)")))
    second = seen()
    assert {m for m in first if first[m] != second[m]} == {"2024-02"}
    read = lambda: sorted((r.month, r.day, r.close) for r in spark.read.parquet(path).collect())
    want = sorted((m, d, 9.5 if (m, d) == ("2024-02", 3) else c) for _, m, d, c in rows)
    assert read() == want
    put(stored.where("month = '2024-01' AND day = 4").withColumn("note", F.lit("x")))
    assert seen()["2024-01"] != second["2024-01"] and seen()["2024-02"] == second["2024-02"]
    assert read() == want
    put(spark.createDataFrame([("A", "2024-04", 1, None)], stored.schema))
    assert read() == sorted([*want, ("2024-04", 1, None)])


def test_partition_prints_tell_rows_apart(spark):
    """Rows that swap values, null against zero, and copies of a row are changes; another order is none."""
    base = [("m", 1, 2.0), ("m", 2, 1.0), ("m", 2, 1.0), ("k", None, None)]
    frame = lambda rows: spark.createDataFrame(rows, "month string, day int, close double")
    differ = lambda a, b: sorted(r.month for r in lake.changed_partitions(frame(a), frame(b), ["month"]).collect())
    assert differ(base, base[::-1]) == []
    assert differ(base, [("m", 1, 1.0), ("m", 2, 2.0), ("m", 2, 1.0), base[3]]) == ["m"]
    assert differ(base, base[1:]) == ["m"]
    assert differ(base, [*base[:3], ("k", 0, None)]) == ["k"]
    assert differ(base, [*base[:3], ("k", None, 0.0)]) == ["k"]
    assert differ(base[:3], base) == ["k"]
