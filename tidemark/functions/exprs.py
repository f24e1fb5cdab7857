"""Typed column expressions: money, days, totals, shares."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDERS_AS_OF = date(2001, 8, 1)  # stands for "today" over orders
EVENTS_AS_OF = date(2024, 1, 31)  # stands for "today" over events


def money(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(12,2)")


def day(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("date")


def ntz(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")


def micros(col: str | Column) -> Column:
    """Microseconds since the epoch of a wall-clock time; exact in any session time zone."""
    wall = ntz(col)
    days = F.unix_date(wall.cast("date")).cast("bigint") * 86_400_000_000
    clock = (F.hour(wall) * 3600 + F.minute(wall) * 60).cast("bigint") * 1_000_000
    return days + clock + (F.extract(F.lit("SECOND"), wall) * 1_000_000).cast("bigint")


def on(d: date | str) -> Column:
    """Date literal; compared with a timestamp column it is pushed into the scan."""
    return F.lit(d).cast("date")


def back(as_of: date, days: int) -> date:
    return as_of - timedelta(days=days)


def months_back(as_of: date, months: int) -> date:
    """Same day ``months`` earlier, cut to the length of that month."""
    index = as_of.year * 12 + as_of.month - 1 - months
    year, month = divmod(index, 12)
    following = date(year + (month + 1) // 12, (month + 1) % 12 + 1, 1)
    return date(year, month + 1, min(as_of.day, (following - timedelta(days=1)).day))


def total(col: Column) -> Column:
    """Exact decimal sum handed out as double."""
    return F.sum(col).cast("double")


def mean(col: Column) -> Column:
    return F.sum(col).cast("double") / F.count(col)


def share(part: Column, whole: Column) -> Column:
    """``round(100 * part / whole, 2)``; NULL when ``whole`` is zero."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2)
