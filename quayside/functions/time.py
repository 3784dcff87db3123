"""Time parsing and arithmetic on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A time alone would be read as today's, a year alone as its first day.
_DATE = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def parse_time(text: Column) -> Column:
    """ISO-8601 text to a zone-less timestamp; null when empty, unreadable or without a whole date.

    A zone in the text is turned into UTC (the session zone).
    """
    return F.when(text.rlike(_DATE), F.try_to_timestamp(text)).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds with fraction."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def duration_hours(start: Column, end: Column) -> Column:
    """Hours with fraction."""
    return seconds_between(start, end) / F.lit(3600.0)


def time_difference_hours(start: Column, end: Column) -> Column:
    """Whole seconds as hours, with the sign turned: a later end gives a negative number."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(3600.0) * F.lit(-1.0)


def age_days(since: Column, now: Column) -> Column:
    """Age in whole days."""
    return F.floor(F.timestamp_diff("SECOND", since, now) / F.lit(86400.0))


def time_slice(ts: Column, minutes: int) -> Column:
    """Number of the ``minutes``-wide slice a time falls in. Grows with time, needs no zone."""
    minute = (F.unix_date(F.to_date(ts)).cast("bigint") * 1440) + F.hour(ts) * 60 + F.minute(ts)
    return F.floor(minute / F.lit(minutes))
