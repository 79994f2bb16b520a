"""Distinct receipts at any grain from one pass over the lines.

Receipts are numbered once. A day's receipts at a site are bitmaps of 32,768 numbers each, made where the lines
are; bitmaps of a coarser grain are those of the finer one or-ed. Counts are exact, and no grain reads the
lines again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.session import scratch_path
from shelfledger.sources.export import number_rows

NUMBER, BUCKET, BITS = "_receipt_no", "_bucket", "_receipts"


def receipt_numbers(lines: DataFrame, receipt: str, near: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """(receipt, number): a whole number for each receipt code, stored in the scratch folder.

    Receipts that agree in ``near``, such as day and site, get neighbouring numbers, so that they share bitmaps; a
    receipt found at several places gets the number of the least. ``known`` numbers stay, new
    receipts follow the greatest. A null receipt has no number.
    """
    rows = lines.filter(F.col(receipt).isNotNull())
    if known is not None:
        rows = rows.join(known.select(receipt), receipt, "left_anti")
    codes = rows.groupBy(receipt).agg(F.min(F.struct(*near)).alias("_near")).select(receipt, *[F.col(f"_near.{c}").alias(f"_n{i}") for i, c in enumerate(near)])
    found = number_rows(codes, [f"_n{i}" for i in range(len(near))] + [receipt]).select(receipt, F.col("_row").alias(NUMBER))
    if known is not None:
        last = known.agg(F.coalesce(F.max(NUMBER), F.lit(0)))
        found = known.select(receipt, NUMBER).union(found.select(receipt, F.col(NUMBER) + last.scalar()))
    kept = scratch_path(lines.sparkSession, "receipt-numbers")
    found.write.parquet(kept)
    return lines.sparkSession.read.schema(found.schema).parquet(kept)


def receipt_bitmaps(lines: DataFrame, keys: Sequence[str], number: str = NUMBER) -> DataFrame:
    """The bitmaps of the receipts of each key: (keys, bucket, bitmap). Lines without a number count nowhere."""
    n = F.col(number)
    return lines.filter(n.isNotNull()).groupBy(*keys, F.bitmap_bucket_number(n).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias(BITS)
    )


def kept(bitmaps: DataFrame) -> DataFrame:
    """The bitmaps stored in the scratch folder, so that several grains do not build them again each."""
    path = scratch_path(bitmaps.sparkSession, "bitmaps")
    bitmaps.write.option("compression", "zstd").parquet(path)
    return bitmaps.sparkSession.read.schema(bitmaps.schema).parquet(path)


def rolled_up(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of a coarser grain: ``keys`` are columns of ``bitmaps`` that its own keys determine, or a part of these."""
    return bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def receipt_counts(bitmaps: DataFrame, keys: Sequence[str], name: str = "TransCount") -> DataFrame:
    """The number of distinct receipts of each key."""
    return rolled_up(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))
