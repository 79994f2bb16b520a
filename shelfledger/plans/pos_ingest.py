"""Ingest of point-of-sale drops, and repair of missing days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.operators.quality import verify_load
from shelfledger.session import scratch_path
from shelfledger.sources import pos_files, versions

KEYS = ("location", "date")


def read_drop(
    spark: SparkSession, roots: str | Sequence[str], columns: Sequence[str], numeric_cols: Sequence[str],
    header: Sequence[str] | None = None, latest_only: bool = False,
) -> DataFrame:
    """All rows of a drop with location and date.

    ``latest_only``: of equally named files only the newest is read. Rows of a file whose name
    gives no location and date have neither, and are rejects.
    """
    files = pos_files.latest_files(pos_files.drop_files(spark, roots)) if latest_only else None
    rows = pos_files.with_filename_columns(pos_files.read_csv_tree(spark, roots, columns, numeric_cols, header=header, files=files))
    unnamed = F.concat(F.lit("unknown file name: "), "_path")
    return rows.withColumn(
        pos_files.CORRUPT, F.coalesce(pos_files.CORRUPT, F.when(F.col("location").isNull() | F.col("date").isNull(), unnamed))
    )


def ingest(
    spark: SparkSession, roots: str | Sequence[str], target: str, columns: Sequence[str],
    numeric_cols: Sequence[str], whole_locations: bool = True, latest_only: bool = False,
) -> DataFrame:
    """Loads a drop into a table of versioned partitions by location and date; returns the rejects by file.

    All days of a location in the drop are replaced, also those the drop has no rows for; with
    ``whole_locations=False`` only the days it has. All change in one step (``versions``). Rows that do not fit
    are loaded with their numbers NULL, as their other columns may be of use, and counted as rejects. Rows of a
    file without location or date in its name belong nowhere and are only counted. The drop is
    parsed once; the parsed rows stay in the scratch folder, as the rejects are counted from them.
    """
    rows, kept = read_drop(spark, roots, columns, numeric_cols, latest_only=latest_only), scratch_path(spark, "parsed")
    rows.write.parquet(kept)
    rows = spark.read.schema(rows.schema).parquet(kept)
    named = rows.filter("location IS NOT NULL AND date IS NOT NULL").select(*columns, *KEYS)
    versions.reload(named, target, KEYS, scope=("location",) if whole_locations else None)
    return pos_files.reject_counts(rows, ["_path"]).filter("rows_rejected > 0")


def backfill(
    spark: SparkSession, root: str, target: str, requested: DataFrame, columns: Sequence[str],
    numeric_cols: Sequence[str], measure: str, feed: str = "SRP",
) -> DataFrame:
    """Reloads the requested (date, location) pairs from a drop, all in one job.

    Only the newest file of each pair is read. A pair whose file has no rows is emptied; one
    without a file stays as it is. Returns a status per pair: what is missing, or whether the
    pair has a sum of ``measure`` after the load.
    """
    day = F.col("date").cast("date")
    wanted = requested.select(
        day.alias("date"), F.col("location").cast("string").alias("location"),
        F.concat_ws("_", F.lit(feed), F.date_format(day, "yyyyMM")).alias("_month"),
        F.concat_ws("_", F.lit(feed), F.col("location").cast("string"), F.date_format(day, "yyyyMMdd")).alias("name"),
    ).distinct()
    kept = scratch_path(spark, "wanted")
    wanted.write.parquet(kept)
    wanted = spark.read.parquet(kept)

    every = pos_files.drop_files(spark, root)
    files = pos_files.list_files(every)
    found = pos_files.latest_version(files.join(wanted, "name", "left_semi"))
    chosen = every.join(found.select("source"), "source", "left_semi")
    rows = pos_files.with_filename_columns(pos_files.read_csv_tree(spark, root, columns, numeric_cols, files=chosen))
    versions.reload(rows.select(*columns, *KEYS), target, KEYS, wanted.join(found, "name", "left_semi").select(*KEYS))

    loaded = versions.read(spark, target).join(wanted.select(*KEYS), list(KEYS), "left_semi")
    checked = verify_load(wanted.select("date", "location"), loaded, ["date", "location"], measure)
    folders = files.select(F.regexp_extract("folder", f"({feed}_[0-9]{{6}})$", 1).alias("_month")).distinct()
    months = folders.select("_month", F.lit(True).alias("_has_folder"))
    names = files.select("name", F.lit(True).alias("_has_file")).distinct()
    return (
        wanted.join(months, "_month", "left").join(names, "name", "left").join(checked, ["date", "location"])
        .select(
            "date", "location",
            F.when(F.col("_has_folder").isNull(), F.concat(F.lit("Folder "), "_month", F.lit(" not found")))
            .when(F.col("_has_file").isNull(), F.concat("name", F.lit(".csv not found")))
            .otherwise(F.col("status")).alias("status"),
        )
    )
