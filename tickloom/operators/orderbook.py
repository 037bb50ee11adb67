"""Order-book metrics over nested price ladders (higher-order functions, one row at a time)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom import schemas
from tickloom.functions.labels import obi_tag
from tickloom.functions.numbers import finite_or, shortest, to_double
from tickloom.functions.times import bucket, local_time, since
from tickloom.operators.latest import latest_by_key
from tickloom.presets import Timeframe
from tickloom.vocab import BOOK_DEPTH_PCT, LOCAL_ZONE, WALL_MULTIPLE


def _typed(df: DataFrame, side: str) -> bool:
    """Whether a side already holds levels of (p, q) instead of the text pairs of messages."""
    return isinstance(df.schema[side].dataType.elementType, StructType)


def _levels(df: DataFrame, side: str) -> Column:
    """[[price, qty], ...] of text to [(p, q), ...] of double; short levels are dropped."""
    if _typed(df, side):
        return F.col(side)
    full = F.filter(side, lambda level: F.size(level) > 1)
    return F.transform(full, lambda l: F.struct(to_double(l[0]).alias("p"), to_double(l[1]).alias("q")))


def _best(df: DataFrame, side: str) -> Column:
    """Price of a side's first level."""
    first = F.get(side, F.lit(0))
    return first["p"] if _typed(df, side) else to_double(F.get(first, F.lit(0)))


def wire_levels(side: Column) -> Column:
    """[(p, q), ...] as the [[price, qty], ...] of text that messages carry."""
    return F.transform(side, lambda l: F.array(l["p"].cast("string"), l["q"].cast("string")))


def _between(levels: Column, low: Column, high: Column) -> Column:
    return F.filter(levels, lambda l: (l["p"] >= low) & (l["p"] <= high))


def _volume(levels: Column) -> Column:
    return F.aggregate(levels, F.lit(0.0), lambda acc, l: acc + l["q"])


def _wall(levels: Column, multiple: float) -> Column:
    """Largest level (the first one on a tie) if it holds `multiple` times the mean, else NULL."""
    none = F.struct(F.lit(None).cast("double").alias("p"), F.lit(None).cast("double").alias("q"))
    top = F.aggregate(
        levels, none, lambda acc, l: F.when(acc["q"].isNull() | (l["q"] > acc["q"]), l).otherwise(acc)
    )
    return F.when(top["q"] >= F.try_divide(_volume(levels), F.size(levels)) * multiple, top)


def order_book_metrics(
    df: DataFrame, depth_pct: float = BOOK_DEPTH_PCT, wall_multiple: float = WALL_MULTIPLE
) -> DataFrame:
    """Best prices, mid, spread of mid, depth volumes, imbalance, ratio and walls per snapshot.

    A snapshot with an empty side keeps its row with NULL metrics.
    """
    two_sided = (F.coalesce(F.size("bids"), F.lit(0)) > 0) & (F.coalesce(F.size("asks"), F.lit(0)) > 0)
    base = df.select(
        "symbol",
        "timestamp",
        _levels(df, "bids").alias("b"),
        _levels(df, "asks").alias("a"),
        F.when(two_sided, _best(df, "bids")).alias("best_bid"),
        F.when(two_sided, _best(df, "asks")).alias("best_ask"),
    ).withColumn("mid_price", (F.col("best_bid") + F.col("best_ask")) / 2)
    mid = F.col("mid_price")
    near = base.withColumns(
        {
            "b": F.when(mid.isNotNull(), _between(F.col("b"), mid * (1 - depth_pct), mid)),
            "a": F.when(mid.isNotNull(), _between(F.col("a"), mid, mid * (1 + depth_pct))),
        }
    ).withColumns(
        {
            "depth_bid_volume": _volume(F.col("b")),
            "depth_ask_volume": _volume(F.col("a")),
            "bid_wall": _wall(F.col("b"), wall_multiple),
            "ask_wall": _wall(F.col("a"), wall_multiple),
        }
    )
    bid, ask = F.col("depth_bid_volume"), F.col("depth_ask_volume")
    return near.withColumns(
        {
            "spread_pct": F.try_divide(F.col("best_ask") - F.col("best_bid"), mid) * 100,
            "obi": F.when(bid + ask > 0, F.try_divide(bid - ask, bid + ask)).when(mid.isNotNull(), 0.0),
            "bid_ask_ratio": F.when(ask > 0, F.try_divide(bid, ask)),
            "nearest_bid_wall_price": F.col("bid_wall.p"),
            "nearest_bid_wall_volume": F.col("bid_wall.q"),
            "nearest_ask_wall_price": F.col("ask_wall.p"),
            "nearest_ask_wall_volume": F.col("ask_wall.q"),
        }
    ).select(*schemas.columns(schemas.BOOK))


def books_from_levels(levels: DataFrame) -> DataFrame:
    """Nested snapshots from flat (symbol, timestamp, side, price, qty) levels.

    Quantities are summed per price first, with map-side combine; a book then holds every price of its snapshot, best
    first: bids from the highest price, asks from the lowest.
    """
    key = ["symbol", "timestamp"]
    merged = levels.groupBy(*key, "side", "price").agg(F.sum("qty").alias("qty"))

    def side(name: str, rank: Column) -> Column:
        level = F.when(F.col("side") == name, F.struct(rank.alias("r"), F.col("price").alias("p"), F.col("qty").alias("q")))
        ranked = F.array_sort(F.collect_list(level))
        return F.transform(ranked, lambda x: F.struct(x["p"].alias("p"), x["q"].alias("q"))).alias(f"{name}s")

    return merged.groupBy(*key).agg(side("bid", -F.col("price")), side("ask", F.col("price")))


def legacy_imbalance(obi: Column) -> Column:
    """Older 0..1 imbalance, bid / (bid + ask)."""
    return (obi + 1) / 2


def depth_imbalance(df: DataFrame) -> DataFrame:
    """Older 0..1 imbalance over the whole depth of every two-sided snapshot."""
    bid, ask = _volume(F.col("b")), _volume(F.col("a"))
    sides = df.select("symbol", "timestamp", _levels(df, "bids").alias("b"), _levels(df, "asks").alias("a"))
    return sides.where((F.size("b") > 0) & (F.size("a") > 0)).select("symbol", "timestamp", F.try_divide(bid, bid + ask).alias("imbalance"))


def ob_latest(df: DataFrame) -> DataFrame:
    """Newest snapshot per symbol; missing numbers read 0."""
    numbers = [c for c in schemas.columns(schemas.BOOK) if c not in ("symbol", "timestamp")]
    return latest_by_key(df, ["symbol"], ["timestamp"]).select(
        "symbol", "timestamp", *[finite_or(F.col(c), 0).alias(c) for c in numbers]
    )


def ob_summary(df: DataFrame, days: int = 30, as_of=None, month: str | None = None) -> DataFrame:
    """Average, least, greatest and newest imbalance per symbol over the last `days` days; `month` names a 'yyyy-MM' partition column to prune by."""
    known = F.when(F.col("obi").isNotNull(), F.col("timestamp"))
    return since(df, "timestamp", days, as_of, month).groupBy("symbol").agg(
        F.avg("obi").alias("avg_obi"),
        F.min("obi").alias("min_obi"),
        F.max("obi").alias("max_obi"),
        F.max_by("obi", known).alias("latest_obi"),
    )


def ob_trend(df: DataFrame, size: int | str, days: int, as_of=None, month: str | None = None) -> DataFrame:
    """Average imbalance and depth volumes per symbol and bucket; `month` as in `ob_summary`."""
    return (
        since(df, "timestamp", days, as_of, month)
        .groupBy("symbol", bucket(F.col("timestamp"), size).alias("ts"))
        .agg(
            F.avg("obi").alias("avg_obi"),
            F.avg("depth_bid_volume").alias("avg_bid_vol"),
            F.avg("depth_ask_volume").alias("avg_ask_vol"),
        )
    )


def ob_view(df: DataFrame, preset: Timeframe, as_of=None, month: str | None = None) -> DataFrame:
    """The order-book view a timeframe preset asks for."""
    if preset.book_mode == "latest_only":
        return ob_latest(df)
    if preset.book_mode == "summary_30d":
        return ob_summary(df, 30, as_of, month)
    return ob_trend(df, preset.book_bucket, preset.book_days, as_of, month)


def tagged(df: DataFrame) -> DataFrame:
    return df.withColumn("tag", obi_tag(F.col("obi")))


def liquidity_table(df: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Newest snapshot of every symbol as ten (metric, value) text rows."""

    def rounded(name: str, digits: int) -> Column:
        return shortest(F.round(name, digits))

    usd, row = F.lit("$"), latest_by_key(df, ["symbol"], ["timestamp"])
    metrics = [
        ("Last updated", F.date_format(local_time(F.col("timestamp"), zone), "yyyy-MM-dd HH:mm:ss")),
        ("OBI ±0.5%", rounded("obi", 3)),
        ("Bid Volume", rounded("depth_bid_volume", 2)),
        ("Ask Volume", rounded("depth_ask_volume", 2)),
        ("Bid/Ask Ratio", F.concat(rounded("bid_ask_ratio", 2), F.lit("x"))),
        ("Spread", F.concat(rounded("spread_pct", 4), F.lit("%"))),
        ("Nearest Bid Wall", F.concat(usd, rounded("nearest_bid_wall_price", 2))),
        ("Bid Wall Vol", rounded("nearest_bid_wall_volume", 2)),
        ("Nearest Ask Wall", F.concat(usd, rounded("nearest_ask_wall_price", 2))),
        ("Ask Wall Vol", rounded("nearest_ask_wall_volume", 2)),
    ]
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in metrics])
    return row.select("symbol", F.inline(cells))
