"""Point-of-sale file drops written by Spark from the sample tables.

They are written once per session and data folder, into the session's scratch folder. Each
logical file is a directory ``SRP_{location}_{yyyymmdd}.csv`` of parts, so writing scales with
the data. Files hold a quarter of a location group each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampledata.tables import RetailTables, text
from shelfledger.session import scratch_path

HEADER = ["PLU Number", "Descriptor", "Total Qty-Sales", "Total Sales", "Total Margin"]
OTHER_HEADER = ["Descriptor", "Total Sales", "Remarks", "Total Margin", "PLU Number", "Total Qty-Sales"]
COLUMNS = ["plu_number", "descriptor", "total_qty_sales", "total_sales", "total_margin"]
NUMERIC = COLUMNS[2:]

_written: dict[tuple[int, str, str], str] = {}


def file_rows(t: RetailTables) -> DataFrame:
    """SRP sales as file rows. Every 41st receipt has no readable sales figure."""
    sales = F.format_number("item_paid_price", 2)
    return t.pos_srp.select(
        F.col("plu_number").alias("PLU Number"),
        F.col("descriptor").alias("Descriptor"),
        F.format_number("quantity", 1).alias("Total Qty-Sales"),
        F.when(F.col("receipt_number").cast("bigint") % 41 == 0, "n/a").otherwise(sales).alias("Total Sales"),
        F.format_number(F.col("quantity") * 125, 2).alias("Total Margin"),
        F.lit("checked").alias("Remarks"),
        location_of("branch_code").alias("_loc"),
        F.trunc("date", "QUARTER").alias("_day"),
    )


def location_of(branch: str):
    """Six location groups."""
    return text(F.col(branch).cast("int") % 6 + 1216)


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "folder": F.concat(F.lit("SRP_"), F.date_format("_day", "yyyyMM")),
        "name": F.concat(F.lit("SRP_"), "_loc", F.lit("_"), F.date_format("_day", "yyyyMMdd"), F.lit(".csv")),
    })


def _write(rows: DataFrame, columns: list[str], root: str) -> None:
    keys = ["folder", "name"]
    (
        _named(rows).select(*columns, *keys).hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("append").partitionBy(*keys).option("header", True).csv(root)
    )


def _once(t: RetailTables, kind: str, write) -> str:
    key = (id(t.spark.sparkContext), t.sf_dir, kind)
    if key not in _written:
        root = scratch_path(t.spark, f"drop-{kind}")
        write(root)
        _written[key] = root
    return _written[key]


def flat_drop(t: RetailTables) -> str:
    """All rows with one header."""
    return _once(t, "flat", lambda root: file_rows(t).select(*HEADER).write.option("header", True).csv(root))


def tree_drop(t: RetailTables) -> str:
    """All rows by quarter and location, the odd and even quarters with different headers.

    The folder ``old`` holds an outdated version of every first-quarter file.
    """

    def write(root: str) -> None:
        rows = file_rows(t)
        outdated = rows.filter(F.quarter("_day") == 1).withColumn("Total Qty-Sales", F.lit("1,000.5"))
        _write(outdated, HEADER, f"{root}/old")
        odd = F.quarter("_day") % 2 == 1
        _write(rows.filter(odd), HEADER, f"{root}/new")
        _write(rows.filter(~odd), OTHER_HEADER, f"{root}/new")

    return _once(t, "tree", write)
