"""Data-quality operators. Each is one distributed query, whatever the number of keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(
    expected: DataFrame, actual: DataFrame, on: str, measures: Sequence[str], scale: int = 2
) -> DataFrame:
    """Keys whose rounded measures differ, keys found on one side only included.

    Both sides must have one row per key.
    """

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(on, *[F.round(F.col(m), scale).alias(f"{prefix}_{m}") for m in measures])

    both = side(expected, "expected").join(side(actual, "cur"), on, "full")
    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"expected_{m}").eqNullSafe(F.col(f"cur_{m}")) for m in measures],
    )
    columns = [c for m in measures for c in (f"expected_{m}", f"cur_{m}")]
    return both.select(on, *columns, differs.alias("different")).filter("different")


def missing_keys(actual: DataFrame, dates: DataFrame, locations: DataFrame) -> DataFrame:
    """The (date, location) pairs with no row in ``actual``.

    Days are bits: 64 to a word, words by their number. A location's days are or-ed to its words where
    the rows are, so one word a location and task is shuffled; each word is held against the calendar's
    word of that number, and only missing pairs are ever produced. A location meets all words of
    the calendar, one for 64 days.
    """

    def words(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        day = F.unix_date(F.col("date").cast("date"))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(64)))
        numbered = df.select(*keys, F.floor(day / 64).cast("int").alias("_word"), bit.alias("_bit")).filter("_word IS NOT NULL")
        return numbered.groupBy(*keys, "_word").agg(F.bit_or("_bit").alias(name))

    calendar = words(dates, [], "_wanted").agg(F.collect_list(F.struct("_word", "_wanted")))
    wanted = locations.select("location").distinct().withColumn("_calendar", calendar.scalar()).select(
        F.col("location").alias("_location"), F.inline("_calendar")
    )
    present = words(actual, ["location"], "_present").withColumnRenamed("_word", "_of")
    missing = F.col("_wanted").bitwiseAND(F.bitwise_not(F.coalesce("_present", F.lit(0).cast("bigint"))))
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit("_missing", b) == 1)
    return (
        wanted.join(present, (F.col("_location") == F.col("location")) & (F.col("_word") == F.col("_of")), "left")
        .select("_location", "_word", missing.alias("_missing")).filter("_missing <> 0")
        .select(F.col("_location").alias("location"), "_word", F.explode(bits).alias("_bit"))
        .select(F.date_from_unix_date(F.col("_word") * 64 + F.col("_bit")).alias("date"), "location")
    )


def verify_load(
    requested: DataFrame, loaded: DataFrame, keys: Sequence[str], measure: str
) -> DataFrame:
    """``Success`` for each requested key whose loaded measure has a sum, else failed."""
    totals = loaded.groupBy(*keys).agg(F.sum(measure).alias("_total"))
    return requested.join(totals, list(keys), "left").select(
        *keys,
        F.when(F.col("_total").isNotNull(), "Success").otherwise("Verification failed").alias("status"),
    )


def duplicate_counts(df: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """For each key set, how many rows repeat an earlier key.

    The input is read once: it is counted by all keys together, and each key set adds those
    counts up.
    """
    every = list(dict.fromkeys(k for keys in key_sets for k in keys))
    finest = df.groupBy(*every).agg(F.count(F.lit(1)).alias("_n"))
    counts = [
        finest.groupBy(*keys)
        .agg((F.sum("_n") - 1).alias("_extra"))
        .agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("duplicates"))
        .select(F.lit(",".join(keys)).alias("key_set"), "duplicates")
        for keys in key_sets
    ]
    return reduce(DataFrame.unionByName, counts)


def non_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows <> 1")
