"""From clock texts without a date to instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_datetime(day: Column, clock: Column) -> Column:
    """First ``HH:mm:ss`` in ``clock`` on ``day``, else first ``HH:mm``, else NULL.

    A clock out of range is no clock: 10:30:75 falls back to 10:30, and 24:00
    yields NULL.
    """

    def on_day(pattern: str) -> Column:
        found = F.regexp_substr(clock, F.lit(pattern))
        return F.concat(day.cast("string"), F.lit(" "), found).try_cast("timestamp_ntz")

    return F.coalesce(on_day(r"\d{2}:\d{2}:\d{2}"), on_day(r"\d{2}:\d{2}"))


def after_midnight(local: Column, scheduled: Column, threshold_hours: int) -> Column:
    """Move ``local`` to the next day if its hour is far below the scheduled one.

    Both lie on the same calendar day, so the hours between them, counted in
    hour boundaries, are the difference of the hour fields.
    """
    wraps = F.hour(local) - F.hour(scheduled) <= -threshold_hours
    return F.when(wraps, local + F.expr("INTERVAL 1 DAY")).otherwise(local)


def instant(local: Column, timezone: str) -> Column:
    """The instant of a local date and time (session time zone: UTC)."""
    return F.to_utc_timestamp(local, timezone)


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes, cut off toward zero."""
    return F.timestamp_diff("MINUTE", start, end)
