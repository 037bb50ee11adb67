"""News: dedup, quality filter, entity extraction, lookups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.text import good_article, mentioned_symbols, symbol_mentions, text_or_empty
from tickloom.functions.times import since
from tickloom.operators.latest import first_by_key, newest_n
from tickloom.vocab import NEWS_LIMIT, RELEVANT_TERMS, SPAM_TITLE_TERMS, SYMBOL_ALIASES


def news_dedup(df: DataFrame, order: Sequence[str] = ("extracted_at",)) -> DataFrame:
    """First delivery of every article."""
    return first_by_key(df, ["article_id"], order)


def news_quality(df: DataFrame, spam=SPAM_TITLE_TERMS, relevant=RELEVANT_TERMS, **kw) -> DataFrame:
    """Rows that pass the length, spam and relevance rules."""
    return df.where(good_article(F.col("title"), F.col("description"), spam, relevant, **kw))


def with_symbols(df: DataFrame, aliases: Mapping[str, str] = SYMBOL_ALIASES) -> DataFrame:
    """Add `symbols` from title, description and content."""
    parts = [text_or_empty(F.col(c)) for c in ("title", "description", "content")]
    return df.withColumn("symbols", mentioned_symbols(F.concat_ws(" ", *parts), aliases))


def mentions(
    df: DataFrame, aliases: Mapping[str, str] = SYMBOL_ALIASES, columns: Sequence[str] = ("title", "description"), keys: Sequence[str] = ("article_id",)
) -> DataFrame:
    """One row per place where a text column names a symbol: keys, field, symbol, alias, start (characters from 0), length.

    Every place counts, in the order of the text; a NULL or empty column names nothing.
    """

    def named(column: str) -> Column:
        return F.transform(symbol_mentions(F.col(column), aliases), lambda m: F.struct(F.lit(column).alias("field"), m.alias("m")))

    return df.select(*keys, F.explode(F.concat(*map(named, columns))).alias("x")).select(
        *keys, "x.field", F.col("x.m.value").alias("symbol"), F.col("x.m.term").alias("alias"), "x.m.start", "x.m.length"
    )


def about(df: DataFrame, symbols: Iterable[str]) -> DataFrame:
    """Articles that mention any of `symbols`."""
    wanted = F.array(*[F.lit(s) for s in symbols])
    return df.where(F.arrays_overlap("symbols", wanted))


def news_transform(
    df: DataFrame,
    symbols: Iterable[str] | None = None,
    aliases: Mapping[str, str] = SYMBOL_ALIASES,
    order: Sequence[str] = ("extracted_at",),
    **quality,
) -> DataFrame:
    """Dedup, quality, entities, optional symbol filter, stored columns (missing ones NULL)."""
    out = with_symbols(news_quality(news_dedup(df, order), **quality), aliases)
    if symbols:
        out = about(out, symbols)
    return out.select(
        *[
            F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c)
            for c in schemas.columns(schemas.NEWS)
        ]
    )


def by_symbol(df: DataFrame) -> DataFrame:
    """One row per article and mentioned symbol."""
    return df.withColumn("symbol", F.explode("symbols"))


def news_for_symbol(df: DataFrame, symbol: str, days: int, as_of=None, n: int = NEWS_LIMIT, month: str | None = None) -> DataFrame:
    """Newest `n` articles about one symbol; `month` names a 'yyyy-MM' partition column to prune by."""
    rows = since(df, "published_at", days, as_of, month).where(F.array_contains("symbols", symbol))
    return rows.orderBy(F.desc("published_at"), "article_id").limit(n)


def news_per_symbol(df: DataFrame, days: int, as_of=None, n: int = NEWS_LIMIT, month: str | None = None) -> DataFrame:
    """Newest `n` articles of every symbol; `month` as in `news_for_symbol`."""
    rows = by_symbol(since(df, "published_at", days, as_of, month))
    return newest_n(rows, ["symbol"], [F.desc("published_at"), F.asc("article_id")], n, rank="rank")


def news_mentions(df: DataFrame) -> DataFrame:
    """Articles per symbol and day."""
    return (
        by_symbol(df.select("symbols", F.to_date("published_at").alias("day")))
        .groupBy("symbol", "day")
        .agg(F.count(F.lit(1)).alias("n_articles"))
    )
