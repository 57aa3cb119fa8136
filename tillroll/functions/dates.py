"""Date helpers (IO10, PF9, F13-F17). Pure column expressions; the report date is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value) -> Column:
    """Literal date from a `date` or ISO string."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def half_open(col: Column | str, start, end) -> Column:
    """`start <= col < end` (PF9). Dates compare against timestamps at midnight, as in the warehouse."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= as_date(start)) & (c < as_date(end))


def between_dates(col: Column | str, first, last) -> Column:
    """Inclusive date window on the calendar date of `col` (PF10 with S9: cast to date first)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(c).between(as_date(first), as_date(last))


def month_start(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.trunc(F.to_date(c), "MM")


def month_index(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.year(c) * 12 + F.month(c)


def months_between_boundaries(start: Column | str, end: Column | str) -> Column:
    """DATEDIFF(month, start, end) counting month boundaries crossed."""
    return (month_index(end) - month_index(start)).cast("bigint")


def previous_month(as_of) -> tuple[dt.date, dt.date, str, str]:
    """Previous full month relative to `as_of`: (first day, exclusive end, 'yyyymm', month abbreviation) (IO10)."""
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    end = d.replace(day=1)
    start = (end - dt.timedelta(days=1)).replace(day=1)
    return start, end, f"{start.year}{start.month:02d}", start.strftime("%b")
