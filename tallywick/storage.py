"""Intermediate tables: written once in the folder that all executors share, so that a lost executor loses nothing."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows, and bytes as stored, up to which a lookup table may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20

_written: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local session without that setting gets a temporary folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or None
    if found is None:
        known = spark.sparkContext.getCheckpointDir()
        if known:
            return known
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tallywick-")
        spark.sparkContext.setCheckpointDir(found)
        _written.add(found)
    return found


def workspace(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the program ends."""
    path = f"{shared_dir(spark).rstrip('/')}/tallywick-{label}-{uuid.uuid4().hex}"
    _written.add(path)
    return path


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df in the shared folder and read it back: cuts the lineage, keeps columns prunable and survives lost executors."""
    spark = df.sparkSession
    path = workspace(spark, label)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(table: DataFrame) -> bool:
    """Whether a stored table may be broadcast: few rows, and few bytes in its files."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= BROADCAST_BYTES and table.count() <= BROADCAST_ROWS


def lookup(df: DataFrame, label: str) -> DataFrame:
    """df as the small side of a join: written, measured, and broadcast only if it is small; else joined by shuffle, where AQE splits hot keys."""
    table = materialise(df, label)
    return F.broadcast(table) if is_small(table) else table


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What queries write in the shared folder inside the block is deleted at its end, in whatever file system it lies: write a query's result inside, and a session of many queries doesn't fill the disk."""
    shared_dir(spark)
    before = set(_written)
    try:
        yield
    finally:
        for path in _written - before:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
            _written.discard(path)


@atexit.register
def release() -> None:
    """Delete what this program wrote and didn't delete before, where the shared folder is a mounted one; for other stores, see scratch."""
    while _written:
        path = _written.pop()
        if path.startswith("file:") or path.startswith("/"):
            shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)
