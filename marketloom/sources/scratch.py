"""Where intermediate tables may go."""

from __future__ import annotations

import contextlib
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for scratch tables.

    The folder that the session names in ``spark.checkpoint.dir``, else the checkpoint folder of the
    context, else a folder of the warehouse.  All three are shared between the driver and the
    executors; a machine-local temporary folder is never used, and a warehouse on a local disk is
    refused unless the executors run in the driver.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")) and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse.rstrip('/')}/_scratch"


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


@contextlib.contextmanager
def open_folders(spark: SparkSession, folders: int) -> Iterator[None]:
    """Let a task keep the files of so many partition folders open while it writes.

    Without, Spark sorts all rows of a task by folder first, so that one file is open at a time; with
    it, a task sorts only what comes after it has met more folders than that.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, folders)
    try:
        yield
    finally:
        spark.conf.set(name, before)


_recorders: list[list[str]] = []


@contextlib.contextmanager
def recorded() -> Iterator[list[str]]:
    """The scratch paths that are given out meanwhile, so that they can be discarded together."""
    paths: list[str] = []
    _recorders.append(paths)
    try:
        yield paths
    finally:
        _recorders.remove(paths)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is there is removed when the driver ends."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    system, jvm_path = _file_system(spark, path)
    system.deleteOnExit(jvm_path)
    for paths in _recorders:
        paths.append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    system, jvm_path = _file_system(spark, path)
    system.delete(jvm_path, True)


def stored(df: DataFrame, label: str = "stored", path: str | None = None) -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    For results that are needed more than once: later readers scan only the
    columns they use, and a lost executor does not recompute what led to them.
    """
    path = path or scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
