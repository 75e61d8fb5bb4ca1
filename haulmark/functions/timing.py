"""Time helpers. Every "now" is an ``as_of`` argument, so results repeat."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def at(as_of: str | dt.datetime) -> Column:
    text = as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text).cast("timestamp")


def _moment(as_of: str | dt.datetime) -> dt.datetime:
    return dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def before(as_of: str | dt.datetime, **span: float) -> Column:
    """``as_of`` minus a span, as a literal the scan can push down."""
    return at(_moment(as_of) - dt.timedelta(**span))


def day_before(as_of: str | dt.datetime, days: int) -> Column:
    """Midnight of ``as_of`` minus whole days (CURRENT_DATE - INTERVAL n DAYS)."""
    day = _moment(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    return at(day - dt.timedelta(days=days))


def parse_ts(c: Column) -> Column:
    """Text to timestamp; unreadable text gives NULL instead of an error."""
    return F.try_to_timestamp(c)


def parse_or(c: Column, fallback: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(c), fallback)


def iso_text(c: Column) -> Column:
    return F.date_format(c, ISO)


def minute_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm")


def clock_text(c: Column) -> Column:
    return F.date_format(c, "HH:mm:ss")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end."""
    return F.timestamp_diff("MINUTE", start, end)


def time_of_day(c: Column) -> Column:
    """Rush-hour class of a timestamp: 7-9, 10-16, 17-19, rest night."""
    hour = F.hour(c)
    return (
        F.when(hour.between(7, 9), "morning_rush")
        .when(hour.between(10, 16), "midday")
        .when(hour.between(17, 19), "evening_rush")
        .otherwise("night")
    )
