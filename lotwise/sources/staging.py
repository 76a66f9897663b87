"""Intermediate tables: written once, read by several branches, independent of executors."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def staging_root(spark: SparkSession) -> str:
    """The shared folder the session names. Only a local session may fall back to its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lotwise-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def staged_path(spark: SparkSession, name: str) -> str:
    """A folder of its own for one intermediate table."""
    app = spark.sparkContext.applicationId
    path = f"{staging_root(spark)}/{app}/{name}-{uuid4().hex}"
    if (written := _written.get()) is not None:
        written.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and return a reader of it.

    Parquet rather than a checkpoint: readers prune columns and row groups, and a lost executor
    costs a re-read, not a recomputation of the event scan. The files stay, as checkpoints do,
    unless they are written within ``freed_staging``.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freed_staging(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged within, once the block ends well; keep them if it fails.

    Nothing that reads them may be used afterwards.
    """
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        folder = hadoop.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
