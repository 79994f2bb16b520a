"""Sinks: partition replacement, aligned appends and row-sliced exports.

All writes go through Spark's committer. A rerun replaces what the run before it wrote, but for
``append_aligned``, which appends again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from shelfledger.functions.classify import export_division
from shelfledger.functions.horizons import as_date
from shelfledger.operators.columns import align_to
from shelfledger.session import scratch_path

# Rows per exported file, as delivered and at most.
SLICE_ROWS = 999_999
MAX_SLICE_ROWS = 1_000_000


def _replace(df: DataFrame, keys: Sequence[str]):
    """Writer that replaces the partitions present in ``df``.

    Rebalancing gathers each partition's rows into few files and splits large partitions over
    several tasks.
    """
    return (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
    )


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replaces the stored partitions that ``df`` has rows for and leaves the others alone.

    ``["location"]`` replaces whole locations, ``["location", "date"]`` single days. Each partition changes
    by itself; ``versions.reload`` changes all in one step, and can empty partitions too.
    """
    _replace(df, keys).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, on any storage Spark reaches."""
    system, where = _hadoop(spark, path)
    system.delete(where, True)


def append_aligned(df: DataFrame, path: str, schema: StructType, keys: Sequence[str] = ()) -> None:
    """Appends with exactly the target's columns and types."""
    align_to(df, schema).write.mode("append").partitionBy(*keys).parquet(path)


class _Numbered:
    """Rows numbered by range partition; the scratch table behind them is removed at the end."""

    def __init__(self, df: DataFrame, order: Sequence[str]):
        self.spark, self.path = df.sparkSession, scratch_path(df.sparkSession, "ordered")
        self.rows = number_rows(df, order, self.path)

    def __enter__(self) -> _Numbered:
        return self

    def slices(self, rows: int) -> int:
        """How many slices of ``rows`` there are, at least 1; counted in the scratch table's footers."""
        return max(1, -(-self.spark.read.parquet(self.path).count() // rows))

    def __exit__(self, *_) -> None:
        remove(self.spark, self.path)


def _one_slice_a_task(df: DataFrame, slices: int) -> DataFrame:
    """Rows with ``file_ver`` dealt by its number itself, so that no two slices meet in a task, in order."""
    return df.repartitionById(slices, F.col("file_ver") - 1).sortWithinPartitions("file_ver", "_row").drop("_row")


def number_rows(df: DataFrame, order: Sequence[str], kept: str | None = None) -> DataFrame:
    """Adds ``_row``: 1, 2, ... in the given order, without ever holding all rows in one task.

    The rows are range-partitioned and sorted, and written to the scratch folder with partition
    number and position. The row number is the position plus the rows of the partitions before;
    only that last sum, over one row per partition, is taken in a single task. All columns
    follow the order columns in the sort, and then a number made per row, so that a run of equal
    rows is split over partitions like any other; equal rows may change places without effect.
    """
    spark = df.sparkSession
    rest = [c for c in df.columns if c not in order]
    placed = df.withColumn("_tie", F.monotonically_increasing_id()).orderBy(
        *order, *[F.col(f"`{c}`") for c in rest], "_tie"
    ).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
    )
    kept = kept or scratch_path(spark, "ordered")
    placed.write.parquet(kept)
    stored = spark.read.schema(placed.schema).parquet(kept)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    # one row per partition of the sort, so the size is bounded by the partition count
    return stored.join(F.broadcast(starts), "_part").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + F.col("_pos") + 1).alias("_row")
    )


def _version(rows: int) -> Column:
    if not 0 < rows <= MAX_SLICE_ROWS:
        raise ValueError(f"slice length must be between 1 and {MAX_SLICE_ROWS}, got {rows}")
    return F.expr(f"cast((_row - 1) div {rows} + 1 as int)")


def with_file_version(df: DataFrame, order: Sequence[str], rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``file_ver``: 1 for the first ``rows`` rows in order, 2 for the next, and so on.

    The numbered rows stay in the scratch folder, as the result reads them lazily.
    """
    version = _version(rows)
    return number_rows(df, order).withColumn("file_ver", version).drop("_row")


def write_slices(
    df: DataFrame, path: str, rows: int = SLICE_ROWS, order: Sequence[str] = (), suffix: str = ".csv"
) -> None:
    """One ordered CSV file with header per slice, below ``file_ver=n``.

    The whole path is replaced, so that a shorter rerun leaves no slice of a longer one behind.
    ``suffix=".txt"`` names the same content as text files.
    """
    version = _version(rows)
    with _Numbered(df, order) as numbered:
        (
            _one_slice_a_task(numbered.rows.withColumn("file_ver", version), numbered.slices(rows))
            .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("file_ver")
            .option("header", True).option("extension", suffix.lstrip(".")).csv(path)
        )


def write_fixed_width(
    df: DataFrame, path: str, rows: int = SLICE_ROWS, order: Sequence[str] = ()
) -> None:
    """One text table per slice: right-aligned columns as wide as the slice needs, one blank between.

    Missing values read ``NaN`` in number columns and ``None`` elsewhere.
    """
    version = _version(rows)
    cells = [
        F.coalesce(
            F.col(f"`{f.name}`").cast("string"),
            F.lit("None" if isinstance(f.dataType, StringType) else "NaN"),
        ).alias(f"_v{i}")
        for i, f in enumerate(df.schema.fields)
    ]
    slots = range(len(cells))
    with _Numbered(df, order) as numbered:
        body = numbered.rows.select("_row", version.alias("file_ver"), *cells)
        widths = body.groupBy("file_ver").agg(
            *[
                F.greatest(F.max(F.length(f"_v{i}")), F.lit(len(name))).alias(f"_w{i}")
                for i, name in enumerate(df.columns)
            ]
        )
        head = widths.select(
            "file_ver", F.lit(0).cast("bigint").alias("_row"),
            F.concat_ws(" ", *[F.lpad(F.lit(name), F.col(f"_w{i}"), " ") for i, name in enumerate(df.columns)]).alias("value"),
        )
        lines = body.join(widths, "file_ver").select(
            "file_ver", "_row",
            F.concat_ws(" ", *[F.lpad(F.col(f"_v{i}"), F.col(f"_w{i}"), " ") for i in slots]).alias("value"),
        )
        (
            _one_slice_a_task(head.unionByName(lines), numbered.slices(rows))
            .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("file_ver").text(path)
        )


def write_calendar_path(
    df: DataFrame, path: str, day: Date | str | Column, dept: str = "Dept"
) -> None:
    """CSV below ``year=/month=/division=``; a rerun replaces the divisions it has rows for.

    A department that no exported division has is an error; the caller chooses what to export.
    """
    when = as_date(day)
    placed = df.withColumns({
        "year": F.date_format(when, "yyyy"),
        "month": F.date_format(when, "MMMM"),
        "division": F.coalesce(
            export_division(F.col(dept)),
            F.raise_error(F.concat(F.lit("no export division for department "), F.coalesce(F.col(dept), F.lit("NULL")))),
        ),
    })
    _replace(placed, ["year", "month", "division"]).option("header", True).csv(path)


def month_folder(day: Date | str | Column) -> Column:
    """``202503 - March``"""
    return F.date_format(as_date(day), "yyyyMM' - 'MMMM")
