"""Published files."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from lotwise.operators.counters import HOST_KEYS

# Lies in every folder that a document was written to, so that no other folder is ever replaced.
MARKER = "_lotwise_document"


def write_rates(rates: DataFrame, path: str) -> None:
    """The flat table in key order, NULL host first."""
    rates.orderBy(*HOST_KEYS).write.mode("overwrite").parquet(path)


def write_document(lines: DataFrame, path: str, files: int | None = None) -> None:
    """Write document lines to ``path`` as the caller asks, whatever their size.

    Without ``files`` the document is one file at ``path``: its sorted ranges pass through one
    task, one after the other. With ``files`` it is a folder at ``path`` with up to that many
    files, written in parallel, which give the document when read in name order.

    An earlier document is replaced only once the new one is written: a file by one overwriting
    rename, a folder by moving the old one aside, back again if the new one cannot take its place.
    A folder that no document was written to is never touched, and a file never replaces a folder
    or a folder a file.
    """
    spark = lines.sparkSession
    fs, target = _place(spark, path)
    exists = fs.exists(target)
    if files is None and exists and fs.getFileStatus(target).isDirectory():
        raise FileExistsError(f"{path} is a folder")
    if files is not None and exists and not fs.exists(hadoop_path(spark, target, MARKER)):
        raise FileExistsError(f"{path} is no folder that a document was written to")
    fresh = hadoop_path(spark, target.getParent(), f".{target.getName()}.{uuid4().hex}")
    if files is None:
        ordered = lines.orderBy(*HOST_KEYS).coalesce(1)
    else:
        ordered = lines.repartitionByRange(files, *HOST_KEYS).sortWithinPartitions(*HOST_KEYS)
    try:
        ordered.select("line").write.text(fresh.toString())
        if files is None:
            _replace_file(spark, fs, fs.globStatus(hadoop_path(spark, fresh, "part-*"))[0].getPath(), target)
        else:
            fs.create(hadoop_path(spark, fresh, MARKER)).close()
            replace_folder(spark, fs, fresh, target)
    finally:
        fs.delete(fresh, True)


def hadoop_path(spark: SparkSession, *parts):
    return spark._jvm.org.apache.hadoop.fs.Path(*parts)


def _place(spark: SparkSession, path: str):
    target = hadoop_path(spark, path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(target)


def _replace_file(spark: SparkSession, fs, source, target) -> None:
    """One rename that overwrites: there is always a whole document at the target."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(kind, 1)
    overwrite[0] = kind.OVERWRITE
    configuration = spark._jsc.hadoopConfiguration()
    hadoop.FileContext.getFileContext(target.toUri(), configuration).rename(source, target, overwrite)


def replace_folder(spark: SparkSession, fs, source, target) -> None:
    aside = hadoop_path(spark, target.getParent(), f".{target.getName()}.{uuid4().hex}")
    earlier = fs.exists(target)
    if earlier and not fs.rename(target, aside):
        raise OSError(f"could not move {target} aside")
    moved = False
    try:
        moved = fs.rename(source, target)
        if not moved:
            raise OSError(f"could not move {source} to {target}")
    finally:
        if earlier and not moved:
            fs.rename(aside, target)
    if earlier:
        fs.delete(aside, True)
