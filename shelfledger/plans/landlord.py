"""End-of-day totals a landlord receives for one store."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.functions.horizons import as_date


def landlord_eod(
    tables: Mapping[str, DataFrame], site: str, outlet: str, day: date | str | None = None,
    excluded: tuple[str, ...] = ("7", "8"),
) -> DataFrame:
    """Sales totals per day of one store without the excluded divisions.

    ``day`` takes one day, as the nightly job does; None gives every day. Items without a known
    department are left out. Charges and taxes the till does not record are 0.
    """
    lines = tables["pos_panda"].filter(F.col("location") == site)
    if day is not None:
        lines = lines.filter(F.col("bizdate") == as_date(day))
    items = tables["item"]
    for prefix in excluded:
        items = items.filter(~F.col("dept").startswith(prefix))
    items = items.select(F.col("itemcode").alias("im_code"))
    totals = (
        lines.join(items, F.col("itemcode") == F.col("im_code"))
        .groupBy("bizdate")
        .agg(
            F.sum("amount").alias("net"), F.sum("sumdisc").alias("disc"),
            F.count_distinct("refno").alias("receipts"),
        )
    )
    return totals.select(
        F.concat(F.lit(f"{outlet}_"), F.date_format("bizdate", "yyyyMMdd")).alias("EOD_ID"),
        F.lit(outlet).alias("OUTLET_NAME"),
        F.lit(f"{outlet}_001").alias("POS_NAME"),
        F.date_format("bizdate", "dd-MM-yyyy").alias("EOD_DATE"),
        F.round("net", 2).alias("TOTAL_SALES"),
        F.round(F.col("net") + F.col("disc"), 2).alias("GROSS_SALES"),
        F.col("receipts").alias("TRAN_COUNT"),
        F.lit(0).alias("VOID_TRAN_COUNT"),
        F.lit(0.0).alias("SERVICE_CHARGE"),
        F.round("disc", 2).alias("DISCOUNT_AMT"),
        F.lit(0.0).alias("VAT_TAX_AMT"),
        F.lit(0.0).alias("SVC_TAX_AMT"),
        F.lit(0.0).alias("ROUNDING_ADJ"),
    )
