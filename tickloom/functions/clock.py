"""Time helpers: everything is epoch milliseconds in UTC, rendered without a zone."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.catalogue import INTERVAL_MS, check_interval, check_ts_kind

DAY_MS = INTERVAL_MS["1d"]
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def interval_ms(interval: str) -> int:
    return INTERVAL_MS[check_interval(interval)]


def time_bucket(ts: Column, width_ms: int) -> Column:
    """Start of the bucket holding ``ts``. Buckets align to UTC midnight."""
    return ts - F.pmod(ts, F.lit(width_ms))


def ts_column(ts_kind: str) -> str:
    """Input clock column for a timestamp kind."""
    return f"{check_ts_kind(ts_kind)}_ts"


def ntz_from_ms(ms: Column) -> Column:
    """Zone-less timestamp; the session time zone has no say in it."""
    return F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH))


def from_epoch_ms(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Add ``datetime`` from an epoch-millisecond column."""
    return df.withColumn("datetime", ntz_from_ms(F.col(column)))


def ms_from_ntz(ts: Column) -> Column:
    """Epoch milliseconds of a zone-less timestamp, truncated."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), ts)


def day_ms(day: date) -> int:
    """Epoch milliseconds of a UTC midnight."""
    midnight = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
    return int(midnight.timestamp()) * 1000


def next_day_ms(day: date) -> int:
    return day_ms(day + timedelta(days=1))


def month_number(day: date) -> int:
    return day.year * 12 + day.month
