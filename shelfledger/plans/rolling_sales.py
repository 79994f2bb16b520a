"""Rolling average daily sales over the stock calendar, and the daily extract from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfledger.functions import calendar, classify
from shelfledger.functions.horizons import as_date, dept_starts_with
from shelfledger.operators.lookups import counted, join_shifted, lookup
from shelfledger.operators.rolling import rolling_daily_average

SPANS = (30, 90)


def stock_day_sales(
    tables: Mapping[str, DataFrame], as_of: date | str | Column | None = None, divisions: Sequence[str] = ()
) -> DataFrame:
    """One row per stock snapshot of an item with the sales of the day before.

    A snapshot of day D is about the sales of D-1, and stands with quantity 0 where nothing was
    sold. Sales are summed per (day, branch, item) before the join. ``as_of`` keeps the days a
    90-day window ending there needs. ``divisions`` keeps the items of these divisions, before
    anything is joined or summed.
    """
    snapshots = tables["stock_daily"].select("extract_day", "branch", "itemcode", "avgdailysales")
    sales = tables["pos_group"]
    if as_of is not None:
        end = as_date(as_of)
        start = F.date_sub(end, max(SPANS) - 1)
        snapshots = snapshots.filter(
            F.col("extract_day").between(F.date_add(start, 1), F.date_add(end, 1))
        )
        sales = sales.filter(F.col("bizdate").between(start, end))
    if divisions:
        own = tables["item"].filter(dept_starts_with(F.col("dept"), *divisions)).select(F.col("itemcode").alias("_item"))
        snapshots = snapshots.join(own, F.col("itemcode") == F.col("_item"), "left_semi")
        sales = sales.join(own, F.col("itemcode") == F.col("_item"), "left_semi")
    sold = sales.groupBy("bizdate", "location", F.col("itemcode").alias("sold_item")).agg(
        F.sum("qty").alias("sold_qty")
    )
    days = join_shifted(
        snapshots.filter("extract_day IS NOT NULL").distinct(), sold,
        [("branch", "location"), ("itemcode", "sold_item")], ("extract_day", "bizdate"), 1,
    )
    items = counted(
        tables["item"].select(F.col("itemcode").alias("im_code"), F.col("dept").alias("Dept"), F.col("description").alias("Description")),
        ["im_code"], ["Dept", "Description"], "n_item",
    )
    banners = counted(
        tables["branch"].select("branch_code", F.col("banner").alias("Banner")),
        ["branch_code"], ["Banner"], "n_branch",
    )
    out = lookup(days, items, [("itemcode", "im_code")])
    out = lookup(out, banners, [("branch", "branch_code")])
    one = F.lit(1)
    copies = F.coalesce("n_item", one) * F.coalesce("n_branch", one)
    kind = sold.schema["sold_qty"].dataType
    return out.select(
        F.date_sub("extract_day", 1).alias("BizDate"),
        F.col("branch").alias("Location"),
        "Dept",
        F.col("itemcode").alias("Itemcode"),
        "Description",
        "Banner",
        F.coalesce((F.col("sold_qty") * copies).cast(kind), F.lit(0)).alias("Qty"),
        F.col("avgdailysales").alias("AvgDailySales"),
    )


def rolling_sales(
    tables: Mapping[str, DataFrame], as_of: date | str | Column | None = None, divisions: Sequence[str] = ()
) -> DataFrame:
    """Average daily sales over 30 and 90 calendar days, for every day or for ``as_of`` only.

    ``divisions`` leaves out the items of all other divisions.
    """
    day = F.col("BizDate")
    rolled = rolling_daily_average(
        stock_day_sales(tables, as_of, divisions), ["Location", "Itemcode"], "BizDate", "Qty", SPANS, as_of
    )
    labels = calendar.sales_calendar(day)
    del labels["Calendar Day Month"]
    return rolled.select(
        *[c.alias(name) for name, c in labels.items()],
        "BizDate", "Location", classify.division(F.col("Dept")).alias("Division"), "Dept", "Itemcode",
        "Description", "Banner", "Qty", "AvgDailySales",
        F.col("ads_rl30").alias("ADS_RL30"), F.col("ads_rl90").alias("ADS_RL90"),
    )


def daily_extract(
    tables: Mapping[str, DataFrame], as_of: date | str, *divisions: str, rolled: DataFrame | None = None
) -> DataFrame:
    """Yesterday's rolling sales of one or more divisions, ordered for export.

    ``rolled`` is a stored result of ``rolling_sales``; without it only the divisions' items and
    the 90 days needed are computed.
    """
    day = F.date_sub(as_date(as_of), 1)
    rows = rolling_sales(tables, day, divisions) if rolled is None else rolled.filter(F.col("BizDate") == day)
    return rows.filter(dept_starts_with(F.col("Dept"), *divisions)).orderBy("Dept", "Itemcode", "Location")
