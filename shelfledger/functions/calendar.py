"""Retail calendar labels, all as built-in column expressions over a date column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# English short names.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def _pick(labels: list[str], place: Column) -> Column:
    """The label at a 1-based place. A constant array is many times cheaper per row than
    ``date_format``."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), place)


def _numbered(names: list[str], sep: str) -> list[str]:
    return [f"{i:02d}{sep}{name}" for i, name in enumerate(names, 1)]


def calendar_year(d: Column) -> Column:
    """``Yr1998``"""
    return F.concat(F.lit("Yr"), F.lpad(F.year(d).cast("string"), 4, "0"))


def calendar_month(d: Column) -> Column:
    """``06. Jun``"""
    return _pick(_numbered(MONTHS, ". "), F.month(d))


def calendar_day_month(d: Column) -> Column:
    """``06. 30`` (month, then day)"""
    return F.concat(
        _pick([f"{i:02d}. " for i in range(1, 13)], F.month(d)), F.lpad(F.dayofmonth(d).cast("string"), 2, "0")
    )


def month_label(d: Column) -> Column:
    """``Jun 1998``"""
    return F.concat(_pick([f"{m} " for m in MONTHS], F.month(d)), F.lpad(F.year(d).cast("string"), 4, "0"))


def week_monday(d: Column) -> Column:
    """Weeks start on Monday; the days before a year's first Monday are week 0."""
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")


def week_number(d: Column) -> Column:
    """Week of the year where the week holding 1 January is always week 1."""
    starts_on_monday = F.weekday(F.trunc(d, "YEAR")) == 0
    return week_monday(d) + F.when(starts_on_monday, 0).otherwise(1)


def week_year(d: Column) -> Column:
    """``27.1998``"""
    return F.concat(week_number(d).cast("string"), F.lit("."), F.year(d).cast("string"))


def wk(d: Column) -> Column:
    """``Wk27``"""
    return F.concat(F.lit("Wk"), F.lpad(week_number(d).cast("string"), 2, "0"))


def calendar_day_week(d: Column) -> Column:
    """``01.Mon`` to ``07.Sun``"""
    return _pick(_numbered(WEEKDAYS, "."), F.weekday(d) + 1)


def delivery_month(d: Column) -> Column:
    """``06.Jun``"""
    return _pick(_numbered(MONTHS, "."), F.month(d))


def calendar_wk_num(d: Column) -> Column:
    """Sunday-based week number of the Monday on or before ``d``.

    The first days of January may so carry the last week number of the year before.
    """
    monday = F.trunc(d, "WEEK")
    week = F.floor((F.dayofyear(monday) + 7 - F.dayofweek(monday)) / 7)
    return F.concat(F.lit("Wk"), F.lpad(week.cast("string"), 2, "0"))


def sales_calendar(d: Column) -> dict[str, Column]:
    """The calendar labels every sales report carries, by output column name."""
    return {
        "Calendar Year": calendar_year(d),
        "Calendar Month": calendar_month(d),
        "WeekYear": week_year(d),
        "Wk": wk(d),
        "Calendar Day Month": calendar_day_month(d),
        "Calendar Day Week": calendar_day_week(d),
    }


def calendar_dim(df: DataFrame, date: str) -> DataFrame:
    """One row per distinct date of ``df`` with its labels.

    Reports compute labels inline instead, which needs no join; this is the stand-alone
    dimension for consumers that want one.
    """
    d = F.col(date)
    return (
        df.select(d.cast("date").alias(date))
        .distinct()
        .select(
            d,
            month_label(d).alias("Month"),
            week_year(d).alias("WeekYear"),
            wk(d).alias("Wk"),
            calendar_day_week(d).alias("Calendar Day Week"),
        )
    )
