"""Exact copies of texts: two passes over a Bloom filter, DataFrame functions only.

The first pass counts, for every row, the filter slots its text hash falls into. Slots hit twice or
more make the filter of possibly repeated texts. The second pass probes it: a row with a slot that
was hit only once has a text of its own and passes straight through; only the other rows, all real
copies and about one in 250 of the rest, shuffle by their digest to be grouped exactly. The filter can
let a row through in vain but never holds a copy back, so the result is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import small, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLOTS_PER_ROW = 16
PROBES = 2
BLOCK_BITS = 32768  # bits of one bitmap of bitmap_construct_agg
# The filter is broadcast up to 8,192 blocks of 4 KB (32 MB, 16 million rows). A larger one is joined
# by block number, which shuffles (row, digest) but still no text.
BROADCAST_BLOCKS = 8192


def _slot(probe: int, slots: int):
    return F.pmod(F.xxhash64("text_sha256", F.lit(probe)), F.lit(slots))


def repeated_filter(keys: DataFrame, slots: int) -> DataFrame:
    """(block, bits): the bit of every slot that two or more rows of ``keys`` fall into."""
    hit = (
        keys.select(F.explode(F.array(*[_slot(p, slots) for p in range(PROBES)])).alias("slot"))
        .groupBy("slot").count().filter("count > 1")
    )
    return hit.groupBy(F.expr(f"slot div {BLOCK_BITS}").alias("block")).agg(
        F.bitmap_construct_agg(F.col("slot") % BLOCK_BITS).alias("bits")
    )


def _possibly_repeated(keys: DataFrame, bits: DataFrame, slots: int) -> DataFrame:
    blocks = bits.count()
    every = F.lit(True)
    for p in range(PROBES):
        own = small(bits.select(F.col("block").alias(f"block{p}"), F.col("bits").alias(f"bits{p}")), blocks, BROADCAST_BLOCKS)
        keys = keys.withColumn(f"slot{p}", _slot(p, slots)).withColumn(f"block{p}", F.expr(f"slot{p} div {BLOCK_BITS}"))
        keys = keys.join(own, f"block{p}", "left")
        byte = F.expr(f"cast(conv(hex(substring(bits{p}, cast(slot{p} % {BLOCK_BITS} div 8 as int) + 1, 1)), 16, 10) as int)")
        bit = F.expr(f"cast(slot{p} % 8 as int)")
        set_ = F.coalesce(F.call_function("getbit", byte, bit) == 1, F.lit(False))
        keys = keys.withColumn(f"hit{p}", set_).drop(f"bits{p}", f"slot{p}", f"block{p}")
        every = every & F.col(f"hit{p}")
    return keys.withColumn("possible", every).drop(*[f"hit{p}" for p in range(PROBES)])


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the
    largest id stays (a null id is smaller than any other); of rows repeating that id, one stays.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = stored(
        docs.select(F.col(id_col).alias("id"), F.sha2(F.translate(text, UPPER, LOWER), 256).alias("text_sha256"))
        .withColumn("row", F.monotonically_increasing_id()),
        "digests",
    )
    slots = BLOCK_BITS
    while slots < SLOTS_PER_ROW * keys.count():
        slots *= 2
    bits = stored(repeated_filter(keys, slots), "filter")
    probed = stored(_possibly_repeated(keys, bits, slots), "probed")
    possible = probed.filter("possible")
    groups = stored(
        possible.groupBy("text_sha256").agg(F.max(F.struct("id", "row")).alias("keep"), F.count("*").alias("group_size"))
        .filter("group_size > 1"),
        "groups",
    )
    single = F.col("keep").isNull()
    grouped = possible.join(groups, "text_sha256", "left").select(
        "id", F.when(single, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.when(single, True).otherwise(F.col("keep.row") == F.col("row")).alias("kept"), "text_sha256",
    )
    alone = probed.filter("not possible").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    return alone.union(grouped).withColumnRenamed("id", id_col)
