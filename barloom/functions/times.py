"""Date and time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_zone(zone: Column) -> Column:
    """Whether text names a time zone."""
    return F.try_to_timestamp(F.concat(F.lit("2000-01-01 "), zone), F.lit("yyyy-MM-dd VV")).isNotNull()


def midnight_in_zone(day: Column, zone: Column) -> Column:
    """Instant at which ``day`` begins in a known ``zone``; NULL if the day is unreadable.

    The day is year-month-day text, where month and day may lack a leading zero.
    """
    date = F.when(day.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), day.try_cast("date"))
    return F.to_utc_timestamp(date.cast("timestamp"), zone)


def utc_date(ts: Column | str) -> Column:
    """Day of an instant in the session zone, which the plans pin to UTC."""
    return F.to_date(ts)


def date_in_zone(ts: Column | str, zone: Column | str) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def micros_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def seconds_between(start: Column, end: Column) -> Column:
    return F.round(micros_between(start, end) / F.lit(1e6), 6)


def minutes_between(start: Column, end: Column) -> Column:
    return F.round(micros_between(start, end) / F.lit(1e6) / F.lit(60.0), 6)


def days_old(latest: Column, as_of: dt.date | None = None) -> Column:
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_diff(today, F.to_date(latest))


def check_range(start: dt.date, end: dt.date) -> None:
    if start > end:
        raise ValueError(f"start date {start} lies after end date {end}")


def each_day(start: dt.date, end: dt.date) -> Column:
    """Array of every day from ``start`` through ``end``, both included."""
    check_range(start, end)
    return F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
