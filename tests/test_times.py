import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def at(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize(
    "size, want",
    [
        (60, "2024-01-10 13:47:00"),
        (14400, "2024-01-10 12:00:00"),
        (43200, "2024-01-10 12:00:00"),
        (604800, "2024-01-04 00:00:00"),  # epoch weeks start on Thursday
        ("hour", "2024-01-10 13:00:00"),
        ("day", "2024-01-10 00:00:00"),
        ("week", "2024-01-07 00:00:00"),  # calendar weeks start on Sunday
        ("month", "2024-01-01 00:00:00"),
    ],
)
def test_bucket_on_a_wednesday(spark, size, want):
    assert str(one(spark, times.bucket(at("2024-01-10 13:47:31"), size))) == want


def test_bucket_before_the_epoch(spark):
    assert str(one(spark, times.bucket(at("1969-12-31 23:59:30"), 60))) == "1969-12-31 23:59:00"


@pytest.mark.parametrize(
    "hours, want",
    [(6, 60), (6.01, 300), (24, 300), (72, 900), (168, 3600), (720, 14400), (2160, 43200), (8760, 86400), (8761, 604800)],
)
def test_adaptive_width(hours, want):
    assert times.adaptive_seconds(hours * 3600) == want


@pytest.mark.parametrize("bad", ["2024-13", "2024-1", "24-01", "2024-00", "2024-01-01", "x2024-01"])
def test_bad_month_is_refused(bad):
    with pytest.raises(ValueError):
        times.check_month(bad)


def test_month_bounds_cross_the_year():
    assert times.month_bounds("2023-12") == (dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 1))


@pytest.mark.parametrize(
    "raw, want",
    [(1704067200000, 1704067200000), (1704067200000000, 1704067200000), (10**15, 10**15), (10**15 + 1, 10**12)],
)
def test_epoch_threshold_keeps_the_bound_itself(spark, raw, want):
    assert one(spark, times.epoch_millis(F.lit(raw))) == want


def test_latest_closed_candle(spark):
    assert str(one(spark, times.latest_closed_open(at("2024-01-10 13:47:31")))) == "2024-01-10 13:46:00"
    assert str(one(spark, times.latest_closed_open(at("2024-01-10 13:47:00")))) == "2024-01-10 13:46:00"


def test_completed_months(spark):
    got = one(spark, times.completed_months(at("2024-02-29 10:00:00"), 3))
    assert [str(d) for d in got] == ["2024-01-01", "2023-12-01", "2023-11-01"]


def test_local_time(spark):
    assert str(one(spark, times.local_time(at("2024-01-10 20:00:00"), "Asia/Ho_Chi_Minh"))) == "2024-01-11 03:00:00"
