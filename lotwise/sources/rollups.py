"""A store of sums per day: one folder a day, in it the sums by host and by country.

Every measure is a sum of integers or decimals, so sums of sums are exactly the sums over the
events. A day is written once, when it is closed; runs of later days read its country sums only.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.operators.counters import HOST_KEYS, country_day_sums, host_day_sums
from lotwise.settings import Settings
from lotwise.sources.sinks import hadoop_path, replace_folder

HOST_LEVEL, COUNTRY_LEVEL = "host", "country"


class IncompleteRollup(ValueError):
    """The store lacks days of the window."""


def rollup_root(store: str, settings: Settings) -> str:
    """The folder of the store for the measures of a variant, which are part of its name."""
    return f"{store.rstrip('/')}/{'-'.join(settings.measures)}"


def rollup_schema(settings: Settings) -> T.StructType:
    def measure(name: str) -> T.DataType:
        return T.DecimalType(38, 10) if name == "revenue" else T.LongType()

    return T.StructType(
        [T.StructField(name, T.StringType()) for name in HOST_KEYS]
        + [T.StructField(name, measure(name)) for name in settings.measures]
        + [T.StructField("day", T.DateType()), T.StructField("level", T.StringType())]
    )


def _file_system(spark: SparkSession, root: str):
    return hadoop_path(spark, root).getFileSystem(spark._jsc.hadoopConfiguration())


def _folder(root: str, day: date) -> str:
    return f"{root}/day={day.isoformat()}"


def missing_days(spark: SparkSession, store: str, settings: Settings) -> list[date]:
    """Days of the long window that the store does not hold."""
    root = rollup_root(store, settings)
    fs = _file_system(spark, root)
    return [d for d in settings.days if not fs.exists(hadoop_path(spark, _folder(root, d)))]


def add_days(events: DataFrame, store: str, settings: Settings, days: Iterable[date]) -> None:
    """Sum the events of ``days`` and put them into the store, replacing what it has of them.

    The events are scanned once: country sums are made from the written host sums. All days are
    written beside the store first, then each takes its place by one rename; a run that fails
    leaves whole days or none. A day without events becomes an empty folder, so that it is known
    to be summed.
    """
    days = sorted(set(days))
    if not days:
        return
    spark = events.sparkSession
    root = rollup_root(store, settings)
    fs = _file_system(spark, root)
    fresh = f"{store.rstrip('/')}/.{uuid4().hex}"
    try:
        parts = ["day", "level"]
        hosts = host_day_sums(events, settings, days).withColumn("level", F.lit(HOST_LEVEL))
        hosts.write.partitionBy(*parts).parquet(fresh)
        written = spark.read.schema(rollup_schema(settings)).parquet(fresh)
        countries = country_day_sums(written, settings).withColumn("level", F.lit(COUNTRY_LEVEL))
        countries.write.partitionBy(*parts).mode("append").parquet(fresh)
        fs.mkdirs(hadoop_path(spark, root))
        for day in days:
            source = hadoop_path(spark, _folder(fresh, day))
            fs.mkdirs(source)
            replace_folder(spark, fs, source, hadoop_path(spark, _folder(root, day)))
    finally:
        fs.delete(hadoop_path(spark, fresh), True)


def rollup_rows(spark: SparkSession, store: str, settings: Settings) -> DataFrame:
    """The long window's sums with the columns that ``counters`` has: sums by host of the last
    day, by country of the days before it. Only the folders of these are read."""
    root = rollup_root(store, settings)
    missing = missing_days(spark, store, settings)
    if missing:
        raise IncompleteRollup(f"{root} lacks " + ", ".join(d.isoformat() for d in missing))
    fs = _file_system(spark, root)
    last = settings.day_start.date()
    folders = [
        f"{_folder(root, day)}/level={HOST_LEVEL if day >= last else COUNTRY_LEVEL}" for day in settings.days
    ]
    found = [folder for folder in folders if fs.exists(hadoop_path(spark, folder))]
    schema = rollup_schema(settings)
    if found:
        rows = spark.read.schema(schema).option("basePath", root).parquet(*found)
    else:
        rows = spark.createDataFrame([], schema)
    recent = (F.col("level") == HOST_LEVEL).alias("last_day")
    return rows.select(*HOST_KEYS, recent, *settings.measures)
