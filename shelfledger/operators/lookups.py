"""Joins.

No broadcast hints are given: a dimension is broadcast when Spark's own size check
(``spark.sql.autoBroadcastJoinThreshold``, static or at run time) allows it, and is otherwise
shuffled, with skewed partitions split by adaptive execution. That way nothing is broadcast
that has grown with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.session import scratch_path, shuffles_freed


def header_lines(header: DataFrame, lines: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Documents with their lines; ``on`` is (header key, line key)."""
    return header.join(lines, header[on[0]] == lines[on[1]], "inner")


def item_hierarchy(items: DataFrame, hierarchy: DataFrame, trim_keys: bool = True) -> DataFrame:
    """Items with department, sub-department and category descriptions.

    Each level is looked up in the distinct (code, description) pairs of the hierarchy; items
    missing a level are left out. ``trim_keys`` ignores blanks round the codes. A code with
    two descriptions gives two rows.
    """
    out = items
    for level in ("dept", "subdept", "category"):
        code, desc, key = f"_{level}", f"{level}desc", f"_{level}_key"
        pairs = hierarchy.select(F.col(level).alias(code), desc).distinct()
        tidy = F.trim if trim_keys else (lambda c: c)
        pairs = pairs.select(tidy(F.col(code)).alias(key), desc)
        out = out.join(pairs, tidy(out[level]) == pairs[key], "inner").drop(key)
    return out


def lookup(
    df: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], unique: bool = False
) -> DataFrame:
    """Left join on (left column, dimension column) pairs; the dimension keys are dropped.

    Duplicate keys in the dimension multiply rows. ``unique=True`` checks first, with a job of
    its own, that there are none.
    """
    if unique:
        assert_unique(dim, [r for _, r in on])
    keys = [f"_key{i}" for i in range(len(on))]
    own = [right for _, right in on]
    named = dim.select(
        *[F.col(f"`{c}`") for c in dim.columns if c not in own],
        *[F.col(f"`{right}`").alias(key) for key, right in zip(keys, own)],
    )
    condition = reduce(and_, [df[left] == named[key] for key, (left, _) in zip(keys, on)])
    return df.join(named, condition, "left").drop(*keys)


def staged(df: DataFrame, label: str = "staged") -> DataFrame:
    """``df`` computed at once and stored in the scratch folder; the files of its shuffles are removed.

    For a step whose shuffles take much more room than its rows: later steps find the disk free of them.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def of_known_size(dim: DataFrame) -> DataFrame:
    """A small dimension, stored in the scratch folder.

    Spark estimates the size of joins and aggregates far too high and would shuffle the large side of a lookup. Of
    stored rows its size check knows the size before anything is shuffled.
    """
    return staged(dim, "dimension")


def assert_unique(dim: DataFrame, keys: Sequence[str]) -> None:
    repeated = dim.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"duplicate key {repeated[0].asDict()} in lookup on {list(keys)}")


def counted(dim: DataFrame, keys: Sequence[str], values: Sequence[str], copies: str) -> DataFrame:
    """Distinct (keys, values) of a dimension with the number of rows behind each.

    Joining this instead of the raw dimension keeps the fan-out of duplicate rows as a factor,
    so sums can be taken before the join and multiplied after it.
    """
    return dim.groupBy(*keys, *values).agg(F.count(F.lit(1)).alias(copies))


def join_shifted(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], date: tuple[str, str], days: int
) -> DataFrame:
    """Left join where ``left`` date minus ``days`` equals ``right`` date, plus equal keys.

    The shift is an expression of one side, so the join stays a hash-partitioned equi-join.
    """
    shifted = left.withColumn("_shifted", F.date_sub(F.col(date[0]), days))
    return lookup(shifted, right, [("_shifted", date[1]), *keys]).drop("_shifted")


def join_prefix(
    left: DataFrame, right: DataFrame, prefix_of: tuple[str, str], n: int,
    keys: Sequence[tuple[str, str]] = (), how: str = "left",
) -> DataFrame:
    """Join where ``left`` column equals the first ``n`` characters of ``right`` column."""
    cut = right.withColumn("_prefix", F.substring(F.col(prefix_of[1]), 1, n))
    condition = left[prefix_of[0]] == cut["_prefix"]
    for a, b in keys:
        condition = condition & (left[a] == cut[b])
    return left.join(cut, condition, how).drop("_prefix")


def left_join_suffix(
    a: DataFrame, b: DataFrame, on: str, suffixes: tuple[str, str]
) -> DataFrame:
    """Left join on one column; names found on both sides get the suffixes (case matters)."""
    clash = (set(a.columns) & set(b.columns)) - {on}

    def renamed(df: DataFrame, suffix: str) -> DataFrame:
        return df.toDF(*[c + suffix if c in clash else c for c in df.columns])

    left, right = renamed(a, suffixes[0]), renamed(b, suffixes[1])
    right = right.withColumnRenamed(on, "_on")
    return left.join(right, left[on] == right["_on"], "left").drop("_on")


def current_vendor(vendor: DataFrame) -> DataFrame:
    """Vendors by site and article with trimmed text; ``#`` marks "no vendor" and is left out."""
    text = {
        "Location": "site_key",
        "Location_Name": "site",
        "Itemcode": "article_key",
        "Description": "article",
        "Code": "primary_vendor_key",
        "Name": "primary_vendor",
    }
    # dealt by item before the distinct: no task holds the distinct rows of all it reads, and lookups by item find them in place
    return (
        vendor.filter(F.col("primary_vendor_key") != "#")
        .select(*text.values(), F.trim(F.col("article_key").cast("string")).alias("Itemcode"))
        .repartition("Itemcode")
        .distinct()
        .select(*[
            F.col(name) if name == "Itemcode" else F.trim(F.col(src).cast("string")).alias(name) for name, src in text.items()
        ])
    )


def priority_vendor(stock: DataFrame, suppliers: DataFrame, item_suppliers: DataFrame) -> DataFrame:
    """Vendor of each (item, branch) whose supplier has priority 0."""
    first = item_suppliers.filter(F.col("priority_vendor") == 0).select(
        F.col("code").alias("_sup"), "priority_vendor"
    )
    named = suppliers.select(F.col("code").alias("Code"), F.col("name").alias("Name"))
    return (
        stock.select("itemcode", "branch", "ib_sup_code")
        .distinct()
        .join(first.distinct(), F.col("ib_sup_code") == F.col("_sup"), "inner")
        .join(named.distinct(), F.col("ib_sup_code") == F.col("Code"), "left")
        .select(
            F.col("itemcode").alias("Itemcode"),
            F.col("branch").alias("Location"),
            "Code",
            "Name",
            "priority_vendor",
        )
        .distinct()
    )
