"""Commercial views: one division of the sales view over a date horizon."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.functions.horizons import previous_month_to_date, previous_year_to_date
from shelfledger.plans.sales import unified_sales


def horizon_filter(horizon: str, as_of: date | str | Column) -> Column:
    """``day`` reaches back to the previous month, ``week`` to the previous year, ``month``
    has no limit."""
    day = F.col("BizDate")
    if horizon == "day":
        return previous_month_to_date(day, as_of)
    if horizon == "week":
        return previous_year_to_date(day, as_of)
    if horizon == "month":
        return F.lit(True)
    raise ValueError(f"unknown horizon {horizon!r}")


def commercial(sales: DataFrame, division: str, horizon: str, as_of: date | str | Column) -> DataFrame:
    return sales.filter(F.col("Dept").startswith(division) & horizon_filter(horizon, as_of))


def division_sales(tables: Mapping[str, DataFrame], division: str, horizon: str, as_of: date | str | Column) -> DataFrame:
    """The same from the feeds, of which only the division's lines are summed and joined."""
    return commercial(unified_sales(tables, division, filtered=True), division, horizon, as_of)


def create_views(
    sales: DataFrame, names: list[str], as_of: date | str | Column, suffix: str = "_tmp"
) -> list[str]:
    """(Re)creates a session view per name such as ``vw_d1_day``.

    The character after the first four gives the division and the last word the horizon.
    """
    made = []
    for name in names:
        view = commercial(sales, name[4], name.rsplit("_", 1)[-1], as_of)
        view.createOrReplaceTempView(name + suffix)
        made.append(name + suffix)
    return made


def create_stored_view(
    spark: SparkSession, view: str, source: str, division: str, horizon: str
) -> None:
    """(Re)creates a catalog view over a stored sales table; its horizon follows today's date."""
    since = {
        "day": "AND BizDate BETWEEN trunc(add_months(current_date(), -1), 'MONTH') AND current_date()",
        "week": "AND BizDate BETWEEN trunc(add_months(current_date(), -12), 'YEAR') AND current_date()",
        "month": "",
    }[horizon]
    if not (len(division) == 1 and division.isdigit()):
        raise ValueError(f"division must be one digit, got {division!r}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS "
        f"SELECT * FROM {source} WHERE startswith(Dept, '{division}') {since}"
    )
