"""Join of points with the ranges they fall into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import instant


def interval_join(points: DataFrame, ranges: DataFrame, keys: Sequence[str], at: str, start: str, end: str, bin_seconds: int) -> DataFrame:
    """Every point with every range of its keys that holds it, ends included; key columns once, then both sides' others.

    Time is cut into bins; a point lies in one, a range in all that it touches, so both meet once, in an equi-join
    on keys and bin followed by an exact filter. A hot key is spread over its bins, and a hot bin is left to the adaptive skew
    join. Bins of about the usual range's length keep ranges from being repeated often. Points and ranges without a time meet nothing.
    """

    def number(c: str):
        return F.floor(F.unix_seconds(instant(F.col(c))) / F.lit(bin_seconds))

    left = points.withColumn("__bin", number(at))
    touched = F.when(F.col(start) <= F.col(end), F.sequence(number(start), number(end)))
    right = ranges.withColumn("__bin", F.explode(touched))
    return left.join(right, [*keys, "__bin"]).where(F.col(at).between(F.col(start), F.col(end))).drop("__bin")
