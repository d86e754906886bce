"""Dates, retention and freshness as column expressions; today is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from linepulse.fixed import RETENTION_DAYS, TS


def moment(value: dt.datetime | str | Column) -> Column:
    """``value`` as a UTC wall-clock timestamp; a zone or offset is converted.

    A column has to hold wall-clock time already; see ``utc`` for instants.
    """
    if isinstance(value, Column):
        return value.cast(TS)
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(str(value)).cast(TS)


def utc(instant: Column) -> Column:
    """The UTC wall-clock time of an instant, whatever the time zone of the session."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast(TS) + F.make_dt_interval(zero, zero, zero, seconds)


def day(value: dt.date | str | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def age_years(birth: Column, as_of: dt.date | str | Column) -> Column:
    """Whole years between ``birth`` and ``as_of``."""
    return F.floor(F.months_between(day(as_of), birth) / 12).cast("int")


def retention_stamp(as_of: dt.date | str | Column, days: int) -> Column:
    """Midnight ``days`` after ``as_of``: when a derived row may be removed."""
    return F.date_add(day(as_of), days).cast(TS)


def oldest_of(*moments: Column) -> Column:
    """The least fresh input; missing inputs are skipped."""
    return F.least(*moments)


def plus_days(ts: Column, days: int | Column) -> Column:
    days = F.lit(days) if isinstance(days, int) else days
    return ts + F.make_dt_interval(days)


def recent(date: Column, as_of: dt.date | str | Column, days: int) -> Column:
    """On or after the day ``days`` before ``as_of``."""
    return date >= F.date_sub(day(as_of), days)


def retention_days(purpose: Column) -> Column:
    """Days to keep a row of this purpose; NULL for a purpose without a rule."""
    pairs = [F.lit(x) for item in RETENTION_DAYS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), purpose)


def sla_interval(text: Column) -> Column:
    """``30m``, ``1h`` or ``1d`` as an interval; NULL when it is none of these."""
    amount = F.regexp_extract(text, r"^(\d+)[mhd]$", 1).try_cast("int")
    unit = F.substring(text, -1, 1)
    zero = F.lit(0)
    return (
        F.when(unit == "m", F.make_dt_interval(zero, zero, amount))
        .when(unit == "h", F.make_dt_interval(zero, amount))
        .when(unit == "d", F.make_dt_interval(amount))
    )
