"""Time bucketing, lookbacks and month arithmetic on timestamp columns."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.vocab import CANDLE_STEP_SECONDS, EPOCH_MICROS_THRESHOLD

MONTH_PATTERN = r"^\d{4}-(0[1-9]|1[0-2])$"

# Largest range in seconds -> bucket width in seconds.
ADAPTIVE_STEPS = [
    (6 * 3600, 60),
    (24 * 3600, 300),
    (3 * 24 * 3600, 900),
    (7 * 24 * 3600, 3600),
    (30 * 24 * 3600, 14400),
    (90 * 24 * 3600, 43200),
    (365 * 24 * 3600, 86400),
]
ADAPTIVE_WIDEST = 604800


def instant(ts: Column) -> Column:
    """TIMESTAMP view of a column; zone-less values are read in the session zone (UTC)."""
    return ts.cast("timestamp")


def bucket(ts: Column, size: int | str) -> Column:
    """Start of the bucket that holds `ts`.

    An int is a width in seconds aligned to the epoch (so 604800 starts on Thursdays);
    'hour', 'day' and 'month' are calendar units and 'week' starts on Sunday.
    """
    if isinstance(size, int):
        seconds = F.unix_seconds(instant(ts))
        return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(size)))
    if size == "week":
        return F.date_trunc("day", instant(ts)) - F.make_dt_interval(F.dayofweek(ts) - 1)
    return F.date_trunc(size, instant(ts))


def bucket_seconds(size: int | str) -> int:
    """Grid width in seconds of a fixed-length bucket."""
    if isinstance(size, int):
        return size
    return {"hour": 3600, "day": 86400, "week": 604800}[size]


def adaptive_seconds(range_seconds: float) -> int:
    """Bucket width for a chart that spans `range_seconds`."""
    for limit, width in ADAPTIVE_STEPS:
        if range_seconds <= limit:
            return width
    return ADAPTIVE_WIDEST


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(F.lit(days))


def newest(df: DataFrame, ts: str) -> Column:
    """Scalar subquery: the greatest `ts` of the frame."""
    return df.select(F.max(ts)).scalar()


def as_of_column(df: DataFrame, ts: str, as_of: Column | dt.datetime | None) -> Column:
    """`as_of` as a column; None means the newest value present."""
    if as_of is None:
        return newest(df, ts)
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def from_month(df: DataFrame, low: Column | None = None, high: Column | None = None, month: str | None = None) -> DataFrame:
    """Rows whose partition column `month` ('yyyy-MM') can hold times in [low, high]; all rows if there is no such column."""
    if month is not None and low is not None:
        df = df.where(F.col(month) >= F.date_format(instant(low), "yyyy-MM"))
    if month is not None and high is not None:
        df = df.where(F.col(month) <= F.date_format(instant(high), "yyyy-MM"))
    return df


def since(df: DataFrame, ts: str, days: int, as_of=None, month: str | None = None) -> DataFrame:
    """Rows of the last `days` days before `as_of`; `month` names a partition column to prune by."""
    low = days_before(as_of_column(df, ts, as_of), days)
    return from_month(df.where(F.col(ts) >= low), low, None, month)


def between(
    df: DataFrame, ts: str, start: dt.datetime | None = None, end: dt.datetime | None = None, month: str | None = None
) -> DataFrame:
    """Rows with `ts` in [start, end]; literals of the column's own type, so they reach the scan, and partitions by `month`."""
    kind = dict(df.dtypes)[ts]
    df = from_month(df, *(None if b is None else F.lit(b.isoformat(" ")).cast("timestamp") for b in (start, end)), month)
    for bound, keeps in ((start, F.col(ts).__ge__), (end, F.col(ts).__le__)):
        if bound is not None:
            df = df.where(keeps(F.lit(bound.isoformat(" ")).cast(kind)))
    return df


def check_month(month: str) -> str:
    """Validate a 'YYYY-MM' partition name."""
    if not re.fullmatch(MONTH_PATTERN[1:-1], month):
        raise ValueError(f"Invalid month '{month}'. Expected YYYY-MM.")
    return month


def month_bounds(month: str) -> tuple[dt.datetime, dt.datetime]:
    start = dt.datetime.strptime(check_month(month), "%Y-%m")
    return start, (start + dt.timedelta(days=32)).replace(day=1)


def in_month(df: DataFrame, ts: str, month: str, partition: str | None = None) -> DataFrame:
    """Rows with `ts` in [first of month, first of next month); literals, so it reaches the scan. `partition`: the month column."""
    start, end = month_bounds(month)
    kind = dict(df.dtypes)[ts]
    if partition is not None:
        df = df.where(F.col(partition) == month)
    return between(df, ts, start).where(F.col(ts) < F.lit(end.isoformat(" ")).cast(kind))


def completed_months(as_of: Column, n: int) -> Column:
    """Array with the first day of each of the last `n` completed months, newest first."""
    first = F.trunc(as_of, "month")
    return F.transform(
        F.sequence(F.lit(1), F.lit(n)), lambda i: F.add_months(first, -i.cast("int"))
    )


def epoch_millis(value: Column) -> Column:
    """Epoch number in ms; values above 1e15 are taken as µs."""
    v = value.cast("bigint")
    return F.when(v > EPOCH_MICROS_THRESHOLD, F.floor(v / 1000).cast("bigint")).otherwise(v)


def from_epoch(value: Column) -> Column:
    return F.timestamp_millis(epoch_millis(value))


def latest_closed_open(as_of: Column, step: int = CANDLE_STEP_SECONDS) -> Column:
    """Open time of the newest candle that is already closed at `as_of`."""
    seconds = F.unix_seconds(instant(as_of))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(step)) - step)


def local_time(ts: Column, zone: str) -> Column:
    """Wall-clock time in `zone` of a UTC instant."""
    return F.from_utc_timestamp(instant(ts), zone)


def without_zone(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP column to TIMESTAMP_NTZ (UTC wall clock) for export."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )
