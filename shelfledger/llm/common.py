"""Helpers of the operators: stored tables, size-checked broadcast, clashing columns."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfledger.session import scratch_path

# Tables of ids up to this many rows (16 bytes each, so 64 MB) are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 4_000_000


# Rows reach Python workers in batches of this many bytes at most, one row at least.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the Python workers, which need not have it installed, and bounds the
    session's Arrow batches by bytes: their number of rows alone says nothing about texts."""
    if int(spark.conf.get(_BATCH).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


Batches = Iterator[pa.RecordBatch]


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A task function that gives freed memory back at its end: workers live on between tasks and stages."""

    @wraps(run)
    def task(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library

    return task


def tasks_for(spark: SparkSession, rows: int, each: int) -> int:
    """Tasks that write a table of so many rows: ``each`` rows for one at most, and as many as the session has cores at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


def stored(df: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
    """The rows of ``df`` written to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs its own tasks, not the plan before the table. ``tasks``: files at most,
    so that small tables don't come in a file for each shuffle partition where a session does not join partitions.
    """
    df = df.coalesce(tasks) if tasks else df
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, label: str, tasks: int | None = None) -> tuple[DataFrame, int]:
    """``stored``, and the number of rows, taken as they are written."""
    seen = Observation()
    df = df.coalesce(tasks) if tasks else df
    table = stored(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return table, seen.get["rows"]


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast when its counted rows are within the limit."""
    return F.broadcast(df) if rows <= limit else df


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drops columns that an operator is about to add; the operator's columns win a clash of names."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])
