"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library's plans count on: adaptive execution re-plans joins and splits
# skewed partitions at run time, partition overwrite must only touch the partitions present in
# the data being written, and rows partitioned by one join key need no other shuffle for a join
# on that key and more.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: For plans with long chains of joins, where a session has not set them itself: partitions that shuffles begin with,
#: and the size to which adaptive execution joins them. A task of a chain holds some thirty times that size, and one that
#: reads files sorts some ten times what it reads for each shuffle, which should not spill.
CHAINS = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def one_partitioning(spark: SparkSession) -> None:
    """Settings that the plans with long chains of joins count on, for sessions of any making.

    Joins on several keys use a partitioning by one of them. Shuffles begin with many small partitions, so that what
    a task holds follows from the advisory partition size, not from the size of the tables.
    """
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(key, SETTINGS[key])
    for key, value in CHAINS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is run in it removes the files of its shuffles as soon as it has ended, not when the driver's memory is cleared.

    For writes: their rows lie in files by then. A shuffle that is asked for again is computed again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own; a cluster session must name
    one, because a machine-local folder is lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="shelfledger-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
