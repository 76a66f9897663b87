"""An index of event files by the time they cover, for tables without a day column.

The index is a Parquet table with a row per file: its path, length and time of change, and the
first and last ``record_date`` in it. Files are read for it once, one column of them; a later run
reads new and changed files only, and the events of a window are read from the files that overlap
it, without opening the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.settings import Settings
from lotwise.sources.events import EVENT_SCHEMA, long_window_events

# What makes a file the same file.
FILE = ("file", "length", "changed")
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("changed", T.TimestampType()),
        T.StructField("first", T.TimestampType()),
        T.StructField("last", T.TimestampType()),
    ]
)


def _identity() -> list:
    metadata = ("file_path", "file_size", "file_modification_time")
    return [F.col(f"_metadata.{source}").alias(name) for source, name in zip(metadata, FILE)]


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet files below ``path`` as they are now; only names are looked at."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return files.option("recursiveFileLookup", "true").load(path).select("path", *_identity())


def _indexed(spark: SparkSession, index: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(index)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], INDEX_SCHEMA)
    return spark.read.schema(INDEX_SCHEMA).parquet(index).distinct()


def _read_files(spark: SparkSession, path: str, files: DataFrame) -> DataFrame | None:
    """The rows of some files of the table; like the table's own listing, their paths are held by
    the driver."""
    paths = [r.path for r in files.select("path").collect()]
    if not paths:
        return None
    return spark.read.option("basePath", path.rstrip("/")).parquet(*paths)


def refresh_index(spark: SparkSession, path: str, index: str) -> int:
    """Enter the files that the index lacks or that have changed; returns their number.

    Entries of files that are gone stay and do no harm, as files are always listed anew.
    """
    missing = listed_files(spark, path).join(_indexed(spark, index), list(FILE), "left_anti")
    missing = missing.select("path", *FILE)
    rows = _read_files(spark, path, missing)
    if rows is None:
        return 0
    covered = rows.select(*_identity(), "record_date").groupBy(*FILE).agg(
        F.min("record_date").alias("first"), F.max("record_date").alias("last")
    )
    entries = missing.drop("path").join(covered, list(FILE), "left").select(INDEX_SCHEMA.names)
    entries.write.mode("append").parquet(index)
    return len(rows.inputFiles())


def overlapping_files(spark: SparkSession, path: str, index: str, settings: Settings) -> DataFrame:
    """Files that may hold events of the long window: ``path`` and what the index knows of each.
    A file that is not in the index is one of them."""
    known = listed_files(spark, path).join(_indexed(spark, index).withColumn("known", F.lit(True)), list(FILE), "left")
    within = (F.col("last") >= F.lit(settings.long_start)) & (F.col("first") < F.lit(settings.day_end))
    return known.filter(F.col("known").isNull() | within)


def read_indexed_events(spark: SparkSession, path: str, index: str, settings: Settings) -> DataFrame:
    """Events of the long window, read from the files that overlap it; the index is brought up to
    date first."""
    refresh_index(spark, path, index)
    rows = _read_files(spark, path, overlapping_files(spark, path, index, settings))
    if rows is None:
        return spark.createDataFrame([], EVENT_SCHEMA)
    return long_window_events(rows, settings)
