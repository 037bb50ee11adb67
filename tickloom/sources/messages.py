"""Wire messages: ticker objects, depth snapshots and news articles as JSON text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.text import article_id, text_or_empty
from tickloom.vocab import TICKER_COLUMNS


def parse_ticker_json(df: DataFrame, column: str, more: Sequence[str] = ()) -> DataFrame:
    """One row per ticker object of a JSON array; every field stays text as on the wire.

    `more` names further wire fields to keep, such as closeTime.
    """
    fields = ", ".join(["symbol: string", *[f"{wire}: string" for wire in [*TICKER_COLUMNS, *more]]])
    return df.select(F.inline(F.from_json(column, f"array<struct<{fields}>>")))


def unreadable(df: DataFrame, column: str, kind: str) -> DataFrame:
    """The messages that do not parse as `kind`: what the parsers of this module leave out or empty."""
    parsed = F.from_json(column, kind, {"mode": "PERMISSIVE"})
    return df.where(F.col(column).isNotNull() & parsed.isNull())


def parse_depth_json(df: DataFrame, column: str, symbol: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """Depth message to (symbol, timestamp, bids, asks)."""
    book = F.from_json(column, schemas.DEPTH_MESSAGE)
    empty = F.array().cast("array<array<string>>")
    return df.select(symbol, ts, book.alias("m")).select(
        symbol,
        ts,
        F.coalesce("m.bids", empty).alias("bids"),
        F.coalesce("m.asks", empty).alias("asks"),
    )


def iso_instant(text: Column, default: Column) -> Column:
    """ISO-8601 instant with offset or 'Z'; `default` where the text does not parse."""
    return F.coalesce(F.try_to_timestamp(text), default)


def news_flatten(
    df: DataFrame, column: str, query: Column, as_of: Column, caps: Mapping[str, int] | None = None
) -> DataFrame:
    """Article message to one flat row; a bad date becomes `as_of`.

    Texts are kept whole unless `caps` gives the characters to keep of a field (NEWS_CAPS: those of the stored format).
    """
    a = df.select(F.from_json(column, schemas.ARTICLE_MESSAGE).alias("a"))
    sources = {
        "title": "a.title", "description": "a.description", "content": "a.content", "url": "a.url",
        "image_url": "a.image", "source_name": "a.source.name", "source_url": "a.source.url",
    }
    capped = [
        (F.substring(text, 1, caps[name]) if caps and name in caps else text).alias(name)
        for name, text in ((name, text_or_empty(F.col(path))) for name, path in sources.items())
    ]
    return a.select(
        article_id(F.col("a.url")).alias("article_id"),
        *capped,
        iso_instant(F.col("a.publishedAt"), as_of).alias("published_at"),
        query.alias("search_query"),
        as_of.alias("extracted_at"),
    )


def judged_depth(df: DataFrame, column: str, symbol: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """Every depth message once, parsed once: symbol, timestamp, bids, asks, reason, body.

    reason is NULL for a message that can be stored. It is 'no message' for a null one, 'unreadable' for text that is no JSON
    object of the format, 'no book' for one without both sides; then the book is NULL and body keeps the message.
    """
    raw = "__raw"
    book = F.from_json(column, f"{schemas.DEPTH_MESSAGE}, {raw} string", {"columnNameOfCorruptRecord": raw})
    m = df.select(symbol, ts, F.col(column).alias("body"), book.alias("m"))
    reason = (
        F.when(F.col("body").isNull(), "no message")
        .when(F.col("m").isNull() | F.col(f"m.{raw}").isNotNull(), "unreadable")
        .when(F.col("m.bids").isNull() & F.col("m.asks").isNull(), "no book")
    )
    empty = F.array().cast("array<array<string>>")
    side = lambda c: F.when(F.col("reason").isNull(), F.coalesce(F.col(f"m.{c}"), empty)).alias(c)
    return m.withColumn("reason", reason).select(
        symbol, ts, side("bids"), side("asks"), "reason", F.when(F.col("reason").isNotNull(), F.col("body")).alias("body")
    )


def store_judged(judged: DataFrame, path: str) -> None:
    """Append judged messages in one write: readable ones below `stored=true`, the others, with reason and body, below `stored=false`."""
    judged.withColumn("stored", F.col("reason").isNull()).write.mode("append").partitionBy("stored").parquet(path)


def read_stored(spark, path: str, schema) -> DataFrame:
    """The readable messages of `store_judged`; `schema` is that of the judged ones."""
    return _judged_rows(spark, path, schema, True).drop("reason", "body")


def read_set_aside(spark, path: str, schema) -> DataFrame:
    """The messages that could not be stored, with their reasons."""
    return _judged_rows(spark, path, schema, False)


def _judged_rows(spark, path: str, schema, stored: bool) -> DataFrame:
    with_mark = type(schema)([*schema, *type(schema)().add("stored", "boolean")])
    return spark.read.schema(with_mark).parquet(path).where(F.col("stored") == stored).drop("stored")
