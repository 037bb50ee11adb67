"""Stored index from symbols to articles: one row per mention, by month and load, sorted by symbol and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import since
from tickloom.operators.latest import first_by_key, newest_n
from tickloom.operators.news import by_symbol
from tickloom.vocab import NEWS_LIMIT

#: What reports print of an article; whole texts stay in the article table.
INDEXED = ("symbol", "published_at", "extracted_at", "article_id", "title", "description", "source_name")


def append_index(articles: DataFrame, path: str, load: str) -> None:
    """Add the mentions of one load of articles (with `symbols`); the same load again replaces itself.

    Rows are dealt by month and a hash of symbol and article, so a symbol that most articles mention is not one task's work,
    and sorted by symbol and time, so that a reader of one symbol skips the others' row groups.
    """
    rows = by_symbol(articles).select(*INDEXED).withColumns({"month": F.date_format("published_at", "yyyy-MM"), "load": F.lit(load)})
    dealt = rows.repartition("month", F.pmod(F.xxhash64("symbol", "article_id"), F.lit(8))).sortWithinPartitions("month", "symbol", F.desc("published_at"))
    dealt.drop("load").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("month").parquet(f"{path}/load={load}")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All mentions, with `load` and `month` to prune by."""
    return spark.read.parquet(path).withColumn("month", F.col("month").cast("string"))


def newest_from_index(index: DataFrame, days: int, as_of=None, n: int = NEWS_LIMIT) -> DataFrame:
    """Newest `n` articles of every symbol in the last `days` days, with `rank`; an article that several loads brought counts once.

    Only the months of the lookback are read. Newest rows are limited per task before the shuffle.
    """
    rows = since(index, "published_at", days, as_of, "month")
    once = first_by_key(rows, ["symbol", "article_id"], ["extracted_at", "load"])
    return newest_n(once, ["symbol"], [F.desc("published_at"), F.asc("article_id")], n, rank="rank")


def news_from_index(index: DataFrame, symbol: str, days: int, as_of=None, n: int = NEWS_LIMIT) -> DataFrame:
    """The same for one symbol."""
    return newest_from_index(index.where(F.col("symbol") == symbol), days, as_of, n)
