"""Stock adjustments with calendar and hierarchy labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.functions import calendar, classify
from shelfledger.operators.lookups import header_lines, of_known_size


def adjustments(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Adjustment lines, outgoing ones negative.

    Only lines whose category is in the hierarchy appear, which also leaves out documents
    without lines. The category is matched as it is, blanks included.
    """
    header = tables["adjust_main"].select(F.col("refno").alias("RefNo"), "docdate", F.col("reason").alias("Reason"))
    lines = tables["adjust_child"].withColumnRenamed("refno", "line_refno")
    levels = tables["hierarchy"].select(
        F.col("category").alias("h_category"), "group_desc", "deptdesc", "subdeptdesc", "categorydesc"
    )
    # the labels come last: what is shuffled by document is without them
    joined = header_lines(header, lines, ("RefNo", "line_refno"))
    joined = joined.join(of_known_size(levels), joined["category"] == F.col("h_category"), "inner")
    kind = F.col("adjtype")
    labels = {
        **calendar.sales_calendar(F.col("docdate")),
        "Date": F.col("docdate"),
        "Location": F.col("location"),
        "Division": F.col("group_desc"),
        "Dept": classify.code_label(F.col("dept"), F.col("deptdesc")),
        "SubDept": classify.code_label(F.col("subdept"), F.col("subdeptdesc")),
        "Category": classify.code_label(F.col("category"), F.col("categorydesc")),
        "Itemcode": F.col("itemcode"),
        "Description": F.col("description"),
        "AdjType": kind,
        "Reason": F.col("Reason"),
        "RefNo": F.col("RefNo"),
        "sales_unit_uom": F.col("um"),
        "Qty": classify.signed(kind, F.col("qty")),
        "UnitPrice": classify.signed(kind, F.col("unitprice")),
        "TotalPrice": classify.signed(kind, F.col("totalprice")),
    }
    return joined.select(*[c.alias(name) for name, c in labels.items()])
