"""Candle sources: headerless bulk CSV and JSON arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.numbers import to_double
from tickloom.functions.times import epoch_millis
from tickloom.vocab import RAW_CANDLE_COLUMNS

TIMES = ("open_time", "close_time")


def scan_klines_csv(spark: SparkSession, path: str, symbol: Column | None = None) -> DataFrame:
    """Bulk candle files: positional columns (a twelfth is ignored), times as epoch ms or µs.

    The symbol is taken from the path (`symbol=X/` or the folder or file name `X-1m-...`)
    unless given.
    """
    # the schema names the twelfth column, so that a row with it is legal
    kinds = schemas.RAW_CANDLES + ", ignored string"
    raw = spark.read.schema(kinds).csv(path, header=False, mode="PERMISSIVE", enforceSchema=True)
    where = F.col("_metadata.file_path")
    found = F.coalesce(
        F.nullif(F.regexp_extract(where, r"symbol=([^/]+)/", 1), F.lit("")),
        F.nullif(F.regexp_extract(where, r"/([A-Z0-9]+)-1m-[^/]*$", 1), F.lit("")),
        F.nullif(F.regexp_extract(where, r"/([^/]+)/[^/]+$", 1), F.lit("")),
    )
    return raw.select(
        (found if symbol is None else symbol).alias("symbol"),
        *[
            epoch_millis(F.col(c)).alias(c) if c in TIMES else F.col(c)
            for c in RAW_CANDLE_COLUMNS
        ],
    )


def parse_kline_json(df: DataFrame, column: str, symbol: str = "symbol") -> DataFrame:
    """One row per candle of a JSON array of 12-element arrays; bad numbers become NULL."""
    rows = df.select(symbol, F.explode(F.from_json(column, "array<array<string>>")).alias("k"))
    kinds = dict(part.split() for part in schemas.RAW_CANDLES.split(", "))
    return rows.select(
        F.col(symbol).alias("symbol"),
        *[
            (to_double(F.get("k", F.lit(i))) if kinds[c] == "double" else F.get("k", F.lit(i)).try_cast("bigint")).alias(c)
            for i, c in enumerate(RAW_CANDLE_COLUMNS)
        ],
    )


def judged_klines(df: DataFrame, column: str, symbol: str = "symbol") -> DataFrame:
    """The candles of every page, and a row with a reason for what is none: symbol, the candle's columns, reason, body.

    reason is NULL for a candle that can be stored, 'no message' for a null page, 'unreadable' for one that is no JSON array
    of arrays, 'empty page' for one without candles, 'bad candle' for an array that is too short or has no time; body then
    keeps the page (of a bad candle, its array).
    """
    parsed = F.from_json(column, "array<array<string>>")
    pages = df.select(F.col(symbol).alias("symbol"), F.col(column).alias("body"), parsed.alias("page"))
    rows = pages.select("symbol", "body", F.col("page").isNotNull().alias("read"), F.explode_outer("page").alias("k"))
    kinds = dict(part.split() for part in schemas.RAW_CANDLES.split(", "))
    cells = {
        c: to_double(F.get("k", F.lit(i))) if kinds[c] == "double" else F.get("k", F.lit(i)).try_cast("bigint")
        for i, c in enumerate(RAW_CANDLE_COLUMNS)
    }
    reason = (
        F.when(F.col("body").isNull(), "no message")
        .when(~F.col("read"), "unreadable")
        .when(F.col("k").isNull(), "empty page")
        .when((F.size("k") < len(RAW_CANDLE_COLUMNS)) | cells["open_time"].isNull(), "bad candle")
    )
    kept = F.when(F.col("reason") == "bad candle", F.to_json("k")).when(F.col("reason").isNotNull(), F.col("body"))
    return rows.withColumn("reason", reason).select("symbol", *[F.when(F.col("reason").isNull(), x).alias(c) for c, x in cells.items()], "reason", kept.alias("body"))
