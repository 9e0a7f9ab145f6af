"""Report time: epoch seconds, truncated in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIVE_MINUTES = 300
HOUR = 3600
SIX_HOURS = 6 * HOUR
DAY = 24 * HOUR


def window_end(millis: Column, seconds: int = FIVE_MINUTES) -> Column:
    """End, in epoch seconds, of the tumbling window that holds the instant."""
    start = F.floor(millis / F.lit(seconds * 1000)).cast("bigint") * seconds
    return start + F.lit(seconds).cast("bigint")


def _at(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def bucket_hour(seconds: Column) -> Column:
    return F.unix_timestamp(F.date_trunc("hour", _at(seconds)))


def bucket_day(seconds: Column) -> Column:
    return F.unix_timestamp(F.date_trunc("day", _at(seconds)))


def bucket_6h(seconds: Column) -> Column:
    hour = F.hour(_at(seconds))
    return bucket_hour(seconds) - (hour % 6).cast("bigint") * HOUR


def format_millis(millis: Column, pattern: str) -> Column:
    return F.date_format(F.timestamp_millis(millis), pattern)


def day_text(seconds: Column, pattern: str = "yyyyMMdd") -> Column:
    return F.date_format(_at(seconds), pattern)


def task_windows(seconds: Column) -> dict[str, tuple[Column, Column]]:
    """Last complete hour, six hours, day and five minutes before an instant, each as (upper, lower)."""
    hour, six, day = bucket_hour(seconds), bucket_6h(seconds), bucket_day(seconds)
    minutes = seconds - F.pmod(seconds, F.lit(FIVE_MINUTES))
    return {
        "hour": (hour, hour - HOUR),
        "six_hours": (six, six - SIX_HOURS),
        "day": (day, day - DAY),
        "five_minutes": (minutes, minutes - FIVE_MINUTES),
    }
