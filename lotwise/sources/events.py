"""The event table: daily counters of ad auctions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.functions.measures import in_window
from lotwise.settings import Settings

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("bidder_id", T.StringType()),
        T.StructField("geo_continent", T.StringType()),
        T.StructField("geo_country", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("record_date", T.TimestampType()),
        T.StructField("bids", T.LongType()),
        T.StructField("bid_requests", T.LongType()),
        T.StructField("bid_opportunities", T.LongType()),
        T.StructField("total_top_bids", T.LongType()),
        T.StructField("estimated_adjusted_revenue", T.DecimalType(18, 4)),
    ]
)

RATE_SCHEMA = T.StructType(
    [
        T.StructField("bidder", T.StringType()),
        T.StructField("continent", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("filter", T.DoubleType()),
    ]
)

# Only the refined variant reads these.
REFINED_ONLY = ("bid_opportunities", "estimated_adjusted_revenue")


def _fits(actual: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(wanted, T.LongType):
        return isinstance(actual, T.IntegralType)
    if isinstance(wanted, T.DecimalType):
        return isinstance(actual, (T.DecimalType, T.IntegralType, T.DoubleType, T.FloatType))
    return type(actual) is type(wanted)


def check_columns(events: DataFrame, settings: Settings) -> DataFrame:
    """Fail before the job starts if a column is missing or cannot be summed exactly.

    Revenue may be any number; a floating-point one is made a decimal per event.
    """
    actual = {f.name: f.dataType for f in events.schema.fields}
    problems = []
    for wanted in EVENT_SCHEMA.fields:
        if wanted.name in REFINED_ONLY and not settings.refined:
            continue
        if wanted.name not in actual:
            problems.append(f"{wanted.name} is missing")
        elif not _fits(actual[wanted.name], wanted.dataType):
            found, needed = actual[wanted.name].simpleString(), wanted.dataType.simpleString()
            problems.append(f"{wanted.name} is {found}, needs {needed}")
    if problems:
        raise ValueError("event table: " + "; ".join(problems))
    return events


def long_window_events(events: DataFrame, settings: Settings) -> DataFrame:
    return events.filter(in_window(F.col("record_date"), settings.long_start, settings.day_end))


def day_events(
    spark: SparkSession, path: str, days: Iterable[date], day_column: str | None = None
) -> DataFrame:
    """Events of at least ``days``.

    ``day_column`` names a DATE partition column holding the UTC day of ``record_date``. With it
    the days' folders are asked for by name, and no other folder of the table is listed or read,
    whatever it holds; a day without a folder has no events. Without it the whole table is given,
    for the caller's time filter to prune.
    """
    if not day_column:
        return spark.read.parquet(path)
    root = path.rstrip("/")
    folders = [f"{root}/{day_column}={day.isoformat()}" for day in days]
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [folder for folder in folders if fs.exists(hadoop.Path(folder))]
    if not found:
        return spark.createDataFrame([], EVENT_SCHEMA)
    return spark.read.option("basePath", root).parquet(*found).drop(day_column)


def read_events(
    spark: SparkSession, path: str, settings: Settings, day_column: str | None = None
) -> DataFrame:
    """Events of the long window; ``day_column`` as for ``day_events``. Without it the time filter
    alone prunes Parquet row groups."""
    return long_window_events(day_events(spark, path, settings.days, day_column), settings)


def table_day_events(
    spark: SparkSession, name: str, days: Iterable[date], day_column: str | None = None
) -> DataFrame:
    """Events of at least ``days`` of a catalog table; the catalog finds the days' partitions."""
    events = spark.table(name)
    if day_column:
        days, day = sorted(days), F.col(day_column)
        between = (day >= F.lit(days[0])) & (day <= F.lit(days[-1]))
        events = events.filter(between & day.isin(days)).drop(day_column)
    return events


def table_events(
    spark: SparkSession, name: str, settings: Settings, day_column: str | None = None
) -> DataFrame:
    """Events of the long window of a catalog table."""
    return long_window_events(table_day_events(spark, name, settings.days, day_column), settings)
