"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folder of the innermost `scratch_run`, if any.
_RUN: ContextVar[str | None] = ContextVar("scratch_run", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, else one below the warehouse; a cluster shares at least one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder of the current `scratch_run`, else below the scratch root."""
    return f"{(_RUN.get() or scratch_root(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block, also after an error, all scratch that was written in it.

    Tables that still read from it must be written or collected inside the block.
    """
    path = new_scratch_path(spark, "run")
    outer = _RUN.set(path)
    try:
        yield
    finally:
        _RUN.reset(outer)
        release(spark, path)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write `df` to a scratch table, at `path` if given, and read it back: later plans start from the files."""
    path = path or new_scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Spark's file system; a missing one is no error."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
