"""Rolling average daily sales kept from day to day.

For each (branch, item) the sums of the last 30 and 90 days are stored. A new day adds its own sales and takes
off those of the days that leave the spans, so a run reads three days instead of ninety. Sums of decimal
quantities don't drift: the result equals ``rolling_sales`` over all days. Sums of floating-point quantities
are exact only as long as these are (whole numbers are).

The state of each day is a partition of a versioned table; a rerun of a day starts at the last state before
it. Sales that change for a day already stored ask for that day and all after it to be run again.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfledger.functions import calendar, classify
from shelfledger.plans.rolling_sales import SPANS, stock_day_sales
from shelfledger.sources import versions

Tables = Mapping[str, DataFrame]
KEYS = ["Location", "Itemcode"]
KEPT_DAYS = 7  # days whose state is kept, for reruns


def _sales_of(tables: Tables, first: date, last: date) -> DataFrame:
    """Stock days with sales from ``first`` to ``last``; both feeds are cut to these days before they meet."""
    one = timedelta(days=1)
    cut = {
        "stock_daily": tables["stock_daily"].filter(F.col("extract_day").between(first + one, last + one)),
        "pos_group": tables["pos_group"].filter(F.col("bizdate").between(first, last)),
    }
    return stock_day_sales({"item": tables["item"], "branch": tables["branch"], **cut})


def _sum_type(kind: T.DataType) -> T.DataType:
    """The type of Spark's own sum over values of this type."""
    return T.DecimalType(min(38, kind.precision + 10), kind.scale) if isinstance(kind, T.DecimalType) else kind


def _change(sales: DataFrame, sign: int, spans: tuple[int, ...]) -> DataFrame:
    """Sums and row counts that days add to spans (``sign`` 1) or take off them (-1)."""
    kind = _sum_type(sales.schema["Qty"].dataType)
    amount = F.coalesce("Qty", F.lit(0)).cast(kind) * sign
    return sales.select(*KEYS, *[
        c for n in SPANS for c in (
            (amount if n in spans else F.lit(0)).cast(kind).alias(f"sum{n}"), F.lit(sign if n in spans else 0).cast("bigint").alias(f"rows{n}"))
    ])


def advanced(state: DataFrame, changes: list[DataFrame]) -> DataFrame:
    """The state after changes; keys without a row in the longest span are left out."""
    for change in changes:
        state = state.unionByName(change)
    columns = [f"{kind}{n}" for n in SPANS for kind in ("sum", "rows")]
    sums = state.groupBy(*KEYS).agg(*[F.sum(c).cast(state.schema[c].dataType).alias(c) for c in columns])
    return sums.filter(F.col(f"rows{max(SPANS)}") > 0)


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """The days that have a state."""
    live = versions.partitions(spark, f"{path}/state")
    return [] if live is None else sorted(r[0] for r in live.select("BizDate").collect())


def advance(spark: SparkSession, path: str, tables: Tables, day: date) -> DataFrame:
    """Brings the state below ``path`` to ``day`` and stores that day's result; returns its rows.

    Starts at the last stored day before ``day``, however long ago, or from nothing where there is none.
    """
    before = [d for d in stored_days(spark, path) if d < day]
    added_from = max(before) + timedelta(days=1) if before else day - timedelta(days=max(SPANS) - 1)
    if before:
        state = versions.read(spark, f"{path}/state", where=f"BizDate = DATE'{max(before)}'").drop("BizDate")
        changes = [_change(_sales_of(tables, added_from, day), 1, SPANS)]
        for n in SPANS:
            gone = timedelta(days=n)
            changes.append(_change(_sales_of(tables, added_from - gone, day - gone), -1, (n,)))
    else:
        longest = _sales_of(tables, added_from, day)
        state = _change(longest, 1, (max(SPANS),))
        changes = [_change(longest.filter(F.col("BizDate") > day - timedelta(days=n)), 1, (n,)) for n in SPANS if n < max(SPANS)]
    old = spark.createDataFrame([(d,) for d in before[: 1 - KEPT_DAYS]], "BizDate date") if len(before) >= KEPT_DAYS else None
    versions.reload(advanced(state, changes).withColumn("BizDate", F.lit(day)), f"{path}/state", ["BizDate"], old)
    now = versions.read(spark, f"{path}/state", where=f"BizDate = DATE'{day}'")
    versions.reload(_rows(_sales_of(tables, day, day), now), f"{path}/rows", ["BizDate"], spark.createDataFrame([(day,)], "BizDate date"))
    return read(spark, path, f"BizDate = DATE'{day}'")


def _rows(sales: DataFrame, state: DataFrame) -> DataFrame:
    """A day's stock rows with the averages of their key, as ``rolling_sales`` has them."""
    labels = calendar.sales_calendar(F.col("BizDate"))
    del labels["Calendar Day Month"]
    sums = state.select(*KEYS, *[(F.col(f"sum{n}") / F.lit(n)).alias(f"ADS_RL{n}") for n in SPANS])
    return sales.join(sums, KEYS).select(
        *[c.alias(name) for name, c in labels.items()], "BizDate", "Location", classify.division(F.col("Dept")).alias("Division"), "Dept",
        "Itemcode", "Description", "Banner", "Qty", "AvgDailySales", *[f"ADS_RL{n}" for n in SPANS],
    )


def read(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """Stored results; the ``rolled`` of ``rolling_sales.daily_extract``."""
    return versions.read(spark, f"{path}/rows", where=where)
