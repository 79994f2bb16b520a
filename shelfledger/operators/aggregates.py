"""Aggregations that are more than one built-in call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by_priority(df: DataFrame, keys: Sequence[str], priority: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first by ``priority``.

    Spark cuts every task to its first row per key before the shuffle (WindowGroupLimit), so a
    key holding most of the rows moves one row per task. The remaining columns break ties, so
    that reruns choose the same row.
    """
    named = [c for c in priority if isinstance(c, str)]
    rest = [c for c in df.columns if c not in keys and c not in named]
    order = [*priority, *[F.col(f"`{c}`") for c in rest]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def daily_totals(df: DataFrame, date: str, measures: Sequence[str]) -> DataFrame:
    return df.groupBy(date).agg(*[F.sum(m).alias(m) for m in measures])
