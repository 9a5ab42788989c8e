"""Conversions and calendar functions.

Parsing never raises: malformed input gives null, so quality rules can send the
row to quarantine instead of failing the whole job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.functions.columns import ColumnLike, as_column


def wall_clock(value: ColumnLike) -> Column:
    """Instant whose label is wrong (local hours marked UTC) as plain wall clock.

    Needs a UTC session (``session.require_utc``), then no hour is shifted.
    """
    return as_column(value).cast("timestamp_ntz")


def parse_day(value: ColumnLike, pattern: str = "yyyyMMdd") -> Column:
    return F.try_to_date(as_column(value), pattern)


def parse_hour(value: ColumnLike, pattern: str = "yyyy-MM-dd'T'HH:mm") -> Column:
    """Hour text as wall clock."""
    return F.try_to_timestamp(as_column(value), F.lit(pattern)).cast("timestamp_ntz")


def to_number(value: ColumnLike) -> Column:
    """Text to double; anything that is not a number becomes null."""
    return as_column(value).try_cast("double")


def month_start(value: ColumnLike) -> Column:
    """First day of the month as DATE."""
    return F.trunc(as_column(value), "month")


def slot_start(day: ColumnLike, slot: ColumnLike, minutes: int = 30) -> Column:
    """Start of the n-th slot of a day (slot 1 begins at midnight); null outside the day."""
    number = as_column(slot)
    offset = F.make_dt_interval(mins=(number - 1) * minutes)
    inside = number.between(1, 24 * 60 // minutes)
    return F.when(inside, as_column(day).cast("timestamp_ntz") + offset)


def iso_weekday(value: ColumnLike) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(as_column(value)) + 1).cast("int")


def is_weekend(value: ColumnLike) -> Column:
    return F.weekday(as_column(value)) >= 5


def issue_day(described_day: ColumnLike, horizon_days: ColumnLike | int) -> Column:
    """Day on which a forecast for ``described_day`` was issued."""
    horizon = F.lit(horizon_days) if isinstance(horizon_days, int) else as_column(horizon_days)
    return F.date_sub(as_column(described_day), horizon)


def local_time(instant_utc: ColumnLike, zone: str) -> Column:
    """UTC instant shown as wall clock of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_column(instant_utc).cast("timestamp_ntz"))


def minutes_between(first: ColumnLike, last: ColumnLike) -> Column:
    """Elapsed minutes between two instants, at millisecond resolution."""
    millis = F.unix_millis(as_column(last).cast("timestamp")) - F.unix_millis(as_column(first).cast("timestamp"))
    return millis / 60000


def in_season(value: ColumnLike, first_month: int, last_month: int) -> Column:
    return F.month(as_column(value)).between(first_month, last_month)


def before_month_of(value: ColumnLike, today: dt.date | Column) -> Column:
    """Only complete months: strictly before the month of ``today``."""
    day = today if isinstance(today, Column) else F.lit(today)
    return as_column(value) < F.trunc(day, "month")


def within_last_days(value: ColumnLike, now: dt.datetime | Column, days: int) -> Column:
    instant = now if isinstance(now, Column) else F.lit(now)
    return as_column(value) >= instant - F.make_dt_interval(days=F.lit(days))


def in_day_window(value: ColumnLike, last_day: dt.date, first_offset: int, last_offset: int = 0) -> Column:
    """Rows of the days ``[last_day - first_offset, last_day - last_offset]``, both included.

    The condition is a half-open range on the raw column, so it reaches the
    parquet scan as a pushed filter.
    """
    low = last_day - dt.timedelta(days=first_offset)
    high = last_day - dt.timedelta(days=last_offset)
    column = as_column(value)
    return (column >= F.lit(low)) & (column < F.lit(high + dt.timedelta(days=1)))


def in_closed_month(value: ColumnLike, reference: dt.date) -> Column:
    """Rows of the last complete month before ``reference``."""
    this_month = reference.replace(day=1)
    last_month = (this_month - dt.timedelta(days=1)).replace(day=1)
    column = as_column(value)
    return (column >= F.lit(last_month)) & (column < F.lit(this_month))


def on_lagged_day(value: ColumnLike, reference: dt.date, lag_days: int = 1) -> Column:
    """Rows of the single day ``lag_days`` before ``reference``."""
    return in_day_window(value, reference, lag_days, lag_days)


def years_between(first: dt.date, last: dt.date) -> list[int]:
    """Years touched by a window, in order; names yearly files and partitions."""
    return [first.year + offset for offset in range(last.year - first.year + 1)]
