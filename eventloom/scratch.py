"""Scratch tables below the shared folder, and who owns them."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_folder() -> str:
    return f"file://{tempfile.mkdtemp(prefix='spark-scratch-')}"


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.  Where it is unset, a session in local mode (tests) has one
    of its own; on a cluster that would be lost rows, so it raises."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local_folder()


@contextmanager
def setting(spark: SparkSession, name: str, value: Any) -> Iterator[None]:
    """A setting of the session for what is executed inside; the former one afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def release(spark: SparkSession) -> None:
    """Gives back what finished queries left in the driver: plans that only cycles of Python objects still hold, their
    broadcasts and generated classes in the JVM, and pages that Python's allocator keeps.  Jobs of hundreds of queries
    call it now and then; it takes about as long as a full collection of the driver's heap."""
    gc.collect()
    spark._jvm.System.gc()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


class Scratch:
    """The scratch tables and folders of one run.  Results that read them are lazy, so only who made the Scratch may
    delete them, when those results are written; what nobody deletes goes when the driver ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.of: dict[str, DataFrame | None] = {}

    def path(self) -> str:
        """A new path, of this owner."""
        path = f"{shared_folder(self.spark)}/{uuid.uuid4().hex}"
        fs, at = self._fs(path)
        fs.deleteOnExit(at)
        self.of[path] = None
        return path

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def written(self, df: DataFrame) -> DataFrame:
        """The rows written as Parquet to the shared folder and read again: later steps neither recompute
        them nor depend on an executor that may be lost.  The shuffle files behind them go at once."""
        path = self.path()
        with setting(self.spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            df.write.parquet(path)
        self.of[path] = out = self.spark.read.schema(df.schema).parquet(path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for path in [p for p, t in self.of.items() if any(t is x for x in tables)]:
            self._delete(path)

    def _delete(self, path: str) -> None:
        fs, at = self._fs(path)
        fs.delete(at, True)
        fs.cancelDeleteOnExit(at)
        del self.of[path]

    def delete(self) -> None:
        for path in list(self.of):
            self._delete(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.delete()
