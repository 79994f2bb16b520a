"""Report scripts: SQL text with named parameters, run one by one or by folder, and exported."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from shelfledger.sources.export import SLICE_ROWS, write_slices


def run_script(spark: SparkSession, text: str, **args) -> DataFrame:
    """Runs SQL with ``:name`` parameter markers. Values are bound, not pasted into the text."""
    return spark.sql(text, args=args or None)


def run_folder(spark: SparkSession, folder: str, **args) -> dict[str, DataFrame]:
    """Every ``.sql`` script of a folder, on any storage Spark reads, by its name without suffix."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.sql").select("value", "_metadata.file_name")
    scripts = {unquote(r.file_name).removesuffix(".sql"): r.value for r in files.collect()}
    return {name: run_script(spark, scripts[name], **args) for name in sorted(scripts)}


def export_reports(
    reports: Mapping[str, DataFrame], path: str, order: Mapping[str, Sequence[str]], rows: int = SLICE_ROWS
) -> None:
    """Writes each report as ordered slices below ``path/name``."""
    for name, df in reports.items():
        write_slices(df, f"{path.rstrip('/')}/{name}", rows, order.get(name, ()))
