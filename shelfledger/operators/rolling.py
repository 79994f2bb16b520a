"""Rolling calendar-day averages."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfledger.functions.horizons import as_date


def rolling_daily_average(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    value: str,
    days: int | Sequence[int],
    as_of: Date | str | Column | None = None,
) -> DataFrame:
    """Adds ``ads_rl{n}``: the sum over the last ``n`` calendar days divided by ``n``.

    Days without a row count as 0, and the divisor stays ``n`` at the start of a series too.
    All spans share one shuffle and one sort. The frame is a range of days, so several rows of
    one day see the same sum.

    ``as_of`` gives the rows of that single day only. A date filter cannot pass a window, so
    the input is cut to the longest span before it, which also prunes date partitions.
    """
    spans = [days] if isinstance(days, int) else list(days)
    if as_of is not None:
        end = as_date(as_of)
        df = df.filter(F.col(date).between(F.date_sub(end, max(spans) - 1), end))
    series = Window.partitionBy(*keys).orderBy(F.unix_date(F.col(date)))
    filled = F.coalesce(F.col(value), F.lit(0))
    out = df.withColumns(
        {
            f"ads_rl{n}": F.sum(filled).over(series.rangeBetween(1 - n, 0)) / F.lit(n)
            for n in spans
        }
    )
    return out if as_of is None else out.filter(F.col(date) == as_date(as_of))
