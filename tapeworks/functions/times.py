"""Event-time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch millis of 0001-01-01 and 9999-12-31 23:59:59.999: outside them no calendar date exists.
MIN_EPOCH_MILLIS = -62135596800000
MAX_EPOCH_MILLIS = 253402300799999


def from_millis(millis: Column) -> Column:
    """Epoch millis to a timestamp with its milliseconds; NULL when out of the calendar, never an error."""
    return F.when(millis.between(MIN_EPOCH_MILLIS, MAX_EPOCH_MILLIS), F.timestamp_millis(millis))


def event_time(millis: Column, iso: Column) -> Column:
    """Event time from epoch millis, else from an ISO date-time string.

    Bare digits in the string are not read as a time: a number there has no agreed unit.
    """
    text = F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}"), iso)
    return F.coalesce(from_millis(millis), text.try_cast("timestamp"))


def whole_second(ts: Column) -> Column:
    """Floor to the second, also before 1970."""
    return F.date_trunc("second", ts)


def month_key(ts: Column) -> Column:
    """The month as the integer yyyymm."""
    return F.year(ts) * 100 + F.month(ts)
