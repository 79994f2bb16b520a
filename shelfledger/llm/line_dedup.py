"""Removal of boilerplate lines that stand on many sites, DataFrame functions only.

Each line's hash collects a HyperLogLog sketch of the sites it stands on; sketches merge as they are
aggregated, so a line on every page costs no more than another. Lines with an estimate near the
threshold are counted exactly; the others are decided by the sketch, whose error cannot reach across
that band.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import small, stored, without

LEAST_SITES = 8
LOG_REGISTERS = 9  # 512 registers: 4.6 % standard error
BAND = 0.3  # estimates within 30 % of the threshold, over six standard errors, are counted exactly
ADDED = ["lines_removed"]


def _lines(text):
    return F.split(text, "\n", -1)


def _hash(line):
    return F.xxhash64(F.trim(line))


def boilerplate(docs: DataFrame, text_col: str = "text", site_col: str = "source", least_sites: int = LEAST_SITES) -> DataFrame:
    """(line,) hashes of the lines that stand on ``least_sites`` sites or more. Blank lines never count;
    blanks at a line's ends don't matter; rows without a site are one site."""
    site = F.coalesce(F.concat(F.lit("s"), F.col(site_col).cast("string")), F.lit("none"))
    lines = docs.filter(F.col(text_col).isNotNull()).select(site.alias("site"), F.explode(
        F.transform(F.filter(F.array_distinct(_lines(F.col(text_col))), lambda x: F.trim(x) != ""), _hash)
    ).alias("line"))
    spread = stored(
        lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)).alias("sketch"), F.count("*").alias("rows"))
        .filter(F.col("rows") >= least_sites)
        .select("line", F.hll_sketch_estimate("sketch").alias("sites")),
        "spread",
    )
    near = spread.filter(F.col("sites").between(least_sites * (1 - BAND), least_sites * (1 + BAND) + 1)).select("line")
    counted = (
        lines.join(small(near, near.count()), "line", "left_semi").groupBy("line", "site").agg(F.lit(1).alias("one"))
        .groupBy("line").agg(F.count("*").alias("sites")).filter(F.col("sites") >= least_sites).select("line")
    )
    return spread.filter(F.col("sites") > least_sites * (1 + BAND) + 1).select("line").union(counted)


def without_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                        least_sites: int = LEAST_SITES) -> DataFrame:
    """``docs`` with cross-site lines removed from the text, and lines_removed, their number.

    Null text stays null with 0 lines removed. Rows are told apart by id and text, so rows repeating an
    id are each cleaned by their own lines. A column of the input named lines_removed is replaced; others may have any name.
    """
    kept_columns = without(docs, ADDED).columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("id", "text"))
    found = stored(boilerplate(docs, text_col, site_col, least_sites), "boilerplate")
    at = rows.select("id", "key", F.posexplode(F.transform(_lines(F.col("text")), _hash)).alias("place", "line"))
    hits = at.join(small(found, found.count()), "line", "left_semi")
    removed = stored(hits.groupBy("id", "key").agg(F.collect_set("place").alias("removed")), "removed")
    lines = _lines(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    # merged at every size: the lines to remove grow with the documents
    places = removed.select(F.col("id").alias("of"), F.col("key").alias("of_key"), "removed").hint("merge")
    joined = rows.join(places, (F.col("key") == F.col("of_key")) & F.col("id").eqNullSafe(F.col("of")), "left")
    own = lambda c: F.col("row").getField(c)
    return joined.select(
        *[F.when(F.col("removed").isNotNull(), text).otherwise(own(c)).alias(c) if c == text_col else own(c).alias(c) for c in kept_columns],
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("lines_removed"),
    )
