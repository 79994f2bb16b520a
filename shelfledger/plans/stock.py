"""Stock lists: item master by branch, and stock-take snapshots by banner."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.functions import classify
from shelfledger.functions.horizons import as_date, dept_starts_with


def _banner(tables: Mapping[str, DataFrame], banner: str) -> DataFrame:
    """Branches whose raw banner contains ``banner``; case matters."""
    return tables["branch"].filter(F.col("banner").contains(banner)).select(
        "branch_code", F.col("banner").alias("Banner"), "branch_name"
    )


def itemmaster_stock(
    tables: Mapping[str, DataFrame], banner: str, active: bool, divisions: tuple[str, ...] = ("1", "3")
) -> DataFrame:
    """Stock and cost of the items of some divisions in the branches of a banner.

    ``active`` takes status 0, otherwise every other known status.
    """
    status = F.col("ib_status")
    stock = tables["item_branch_stock"].filter(status == 0 if active else status != 0).select(
        F.col("itemcode").alias("bs_item"), "branch", F.col("qoh").alias("QOH"), "ib_status"
    )
    items = tables["item"].filter(dept_starts_with(F.col("dept"), *divisions))
    branches = _banner(tables, banner)
    return (
        stock.join(branches, stock["branch"] == branches["branch_code"])
        .join(items, F.col("bs_item") == F.col("itemcode"))
        .select(
            "Banner", "branch", "branch_name", classify.division(F.col("dept")).alias("Division"),
            F.col("dept").alias("Dept"), F.col("subdept").alias("SubDept"), F.col("itemcode").alias("Itemcode"),
            F.col("description").alias("Description"), F.col("averagecost").alias("AverageCost"), "QOH",
            F.col("fifocost").alias("FIFOCOST"), F.col("lastcost").alias("LastCost"), "ib_status",
        )
        .orderBy("branch", "Itemcode")
    )


def stock_take(tables: Mapping[str, DataFrame], banner: str, snapshot: date | str) -> DataFrame:
    """Stock on one snapshot day, labelled with the business day before it."""
    day = as_date(snapshot)
    stock = tables["stock_daily"].filter(F.col("extract_day") == day)
    branches = _banner(tables, banner)
    return (
        stock.join(branches, stock["branch"] == branches["branch_code"])
        .select(
            F.date_format(F.date_sub(day, 1), "yyyy-MM-dd").alias("BizDate"), "branch", "branch_name",
            classify.division(F.col("dept")).alias("Division"), F.col("dept").alias("Dept"), "deptdesc",
            F.col("subdept").alias("Subdept"), F.col("subdeptdesc").alias("Subdeptdesc"),
            F.col("category").alias("Category"), F.col("categorydesc").alias("Categorydesc"),
            F.col("itemcode").alias("Itemcode"), F.col("description").alias("Description"),
            F.col("qoh").alias("QOH"), F.col("lastcost").alias("LastCost"),
        )
        .orderBy("branch", "Dept")
    )
