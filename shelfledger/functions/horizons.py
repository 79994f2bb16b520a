"""Date filters relative to a reference day.

``as_of`` is always given by the caller, so that a rerun of a report gives the same rows.
``business_date`` supplies it for live runs.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(day: date | str | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(str(day)).cast("date")


def business_date(offset: str = "+08:00") -> Column:
    """Today's date at the given UTC offset, whatever the session time zone."""
    return F.to_date(F.convert_timezone(None, F.lit(offset), F.localtimestamp()))


def yesterday(d: Column, as_of: date | str | Column) -> Column:
    return d == F.date_sub(as_date(as_of), 1)


def previous_year_to_date(d: Column, as_of: date | str | Column) -> Column:
    """From 1 January of the year before ``as_of`` up to ``as_of``."""
    end = as_date(as_of)
    return d.between(F.trunc(F.add_months(end, -12), "YEAR"), end)


def previous_month_to_date(d: Column, as_of: date | str | Column) -> Column:
    """From the first of the month before ``as_of`` up to ``as_of``."""
    end = as_date(as_of)
    return d.between(F.trunc(F.add_months(end, -1), "MONTH"), end)


def dept_starts_with(dept: Column, *prefixes: str) -> Column:
    """Any of the prefixes; Spark pushes this to the scan as StringStartsWith."""
    hit = dept.startswith(prefixes[0])
    for prefix in prefixes[1:]:
        hit = hit | dept.startswith(prefix)
    return hit
