"""Forecast quality and overlays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.times import between, days_before, from_month, instant, local_time
from tickloom.vocab import LOCAL_ZONE

STEPS_PER_CHUNK = 8192


def forecast_errors(df: DataFrame) -> DataFrame:
    """MAE, MAPE (zero actuals skipped) and RMSE per symbol over known actuals.

    Narrow the input with `times.between` on target_time for a dashboard range.
    """
    err = F.col("actual_close") - F.col("predicted_close")
    share = F.try_divide(F.abs(err), F.col("actual_close")) * 100
    return df.where(F.col("actual_close").isNotNull()).groupBy("symbol").agg(
        F.round(F.avg(F.abs(err)), 4).alias("mae"),
        F.round(F.avg(share), 4).alias("mape"),
        F.round(F.sqrt(F.avg(err * err)), 4).alias("rmse"),
    )


def direction_accuracy(df: DataFrame, steps_per_chunk: int = STEPS_PER_CHUNK) -> DataFrame:
    """Percentage of steps per symbol where forecast and actual moved the same way.

    Steps are compared inside chunks of the unique step index, which bounds every window; the
    step across a chunk border is compared on the chunk ends, one row per chunk.
    """
    known = df.where(F.col("actual_close").isNotNull()).select(
        "symbol",
        "step_index",
        F.floor(F.col("step_index") / steps_per_chunk).alias("c"),
        F.col("actual_close").alias("a"),
        F.col("predicted_close").alias("p"),
    )
    inside = Window.partitionBy("symbol", "c").orderBy("step_index")

    def same(a, a0, p, p0):
        return F.when(a0.isNotNull(), (F.sign(a - a0) == F.sign(p - p0)).cast("int"))

    a, p = F.col("a"), F.col("p")
    steps = known.withColumn("hit", same(a, F.lag(a).over(inside), p, F.lag(p).over(inside)))
    chunks = steps.groupBy("symbol", "c").agg(
        F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"),
        F.count(a).alias("n"),
        *[F.min_by(x, "step_index").alias(f"{x}_first") for x in ("a", "p")],
        *[F.max_by(x, "step_index").alias(f"{x}_last") for x in ("a", "p")],
    )
    across = Window.partitionBy("symbol").orderBy("c")
    borders = chunks.withColumn(
        "border",
        same(
            F.col("a_first"), F.lag("a_last").over(across), F.col("p_first"), F.lag("p_last").over(across)
        ),
    )
    totals = borders.groupBy("symbol").agg(
        (F.sum("hits") + F.coalesce(F.sum("border"), F.lit(0))).alias("hits"), (F.sum("n") - 1).alias("n")
    )
    return totals.select(
        "symbol", F.round(F.try_divide(F.col("hits") * 100.0, F.col("n")), 2).alias("direction_accuracy")
    )


def forecast_overlay(
    klines: DataFrame, predictions: DataFrame, zone: str = LOCAL_ZONE, month: str | None = None
) -> DataFrame:
    """Actual closes between the first forecast of the last day and one hour after the newest one.

    Bounds are one row per symbol, joined on the symbol; their ends reach the scan of the candles, and its
    partitions if `month` names a 'yyyy-MM' partition column.
    """
    day, hour = F.make_dt_interval(F.lit(1)), F.make_dt_interval(hours=F.lit(1))
    newest = predictions.groupBy("symbol").agg(F.max("predicted_at").alias("newest"))
    bounds = (
        predictions.select("symbol", "predicted_at").join(newest, "symbol")
        .where(F.col("predicted_at") >= F.col("newest") - day)
        .groupBy("symbol")
        .agg(F.min("predicted_at").alias("lo"), (F.max("newest") + hour).alias("hi"))
    )
    low, high = bounds.select(F.min("lo")).scalar(), bounds.select(F.max("hi")).scalar()
    window = from_month(klines.where(F.col("open_time").between(low, high)), low, high, month)
    return (
        window.join(bounds, "symbol")
        .where(F.col("open_time").between(F.col("lo"), F.col("hi")))
        .select("symbol", local_time(F.col("open_time"), zone).alias("time"), F.col("close").alias("actual_close"))
    )


def forecast_series(predictions: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Forecasts made in the day before each symbol's newest one."""
    newest = predictions.groupBy("symbol").agg(F.max("predicted_at").alias("newest"))
    return (
        predictions.join(newest, "symbol")
        .where(F.col("predicted_at") >= days_before(F.col("newest"), 1))
        .select("symbol", local_time(F.col("target_time"), zone).alias("time"), "predicted_close")
    )


def local_series(df: DataFrame, ts: str, value: str, out: str, start=None, end=None, zone: str = LOCAL_ZONE):
    """(symbol, local time, value) of rows in [start, end]."""
    rows = between(df, ts, start, end)
    return rows.select("symbol", local_time(instant(F.col(ts)), zone).alias("time"), F.col(value).alias(out))
