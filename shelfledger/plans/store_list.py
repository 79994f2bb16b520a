"""Store-list consolidation from a curated sheet and a raw site sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.functions.classify import normalise_banner
from shelfledger.operators.aggregates import first_by_priority
from shelfledger.operators.lookups import left_join_suffix
from shelfledger.operators.unions import union_by_name


ORDER = ["_from", "site_name", "banner"]


def _both_sheets(stores: DataFrame, locations: DataFrame) -> DataFrame:
    curated = stores.select("site", "site_name", "banner", "area", "remarks_closed_store", F.lit(0).alias("_from"))
    raw = locations.select(
        "site", "site_name", normalise_banner(F.col("banner"), F.col("site_name")).alias("banner"),
        F.lit(1).alias("_from"),
    )
    return union_by_name(curated, raw)


def combined(stores: DataFrame, locations: DataFrame) -> DataFrame:
    """Both sheets, raw banners normalised, one row per (site, name, banner)."""
    return first_by_priority(_both_sheets(stores, locations), ["site", "site_name", "banner"], ORDER).drop("_from")


def consolidate(stores: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per site, with the address and banner of each of the site's raw rows.

    The curated sheet wins over the raw one. Rows of a sheet carry no order in Spark, so the
    first by name, then by banner, is kept; that choice is stable between runs.
    """
    sites = first_by_priority(_both_sheets(stores, locations), ["site"], ORDER).drop("_from")
    sheet = locations.select("site", "site_name", "branch_add", F.col("banner").alias("Banner_old"))
    return left_join_suffix(sites, sheet, "site", ("_excel", "_sheet")).select(
        "site", "site_name_excel", "area", "branch_add", "banner", "Banner_old", "remarks_closed_store"
    )
