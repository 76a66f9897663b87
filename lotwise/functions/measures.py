"""Column expressions for counters and the ratios made from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.settings import DEFAULT, HIGH, LOW, NAN, TOLERATED_ERROR, Settings


def in_window(column: Column, start: datetime, end: datetime) -> Column:
    """Half-open time window; plain comparisons, so Parquet and partition pruning see them."""
    return (column >= F.lit(start)) & (column < F.lit(end))


def utc_day(instant: Column) -> Column:
    """The UTC day of a timestamp, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86_400).cast("int"))


def usable_error(error_code: Column) -> Column:
    return error_code.isNull() | (error_code == TOLERATED_ERROR)


def known_place() -> Column:
    return (F.col("continent") != NAN) & (F.col("country") != NAN)


def is_exempt(settings: Settings) -> Column:
    return F.col("country").isin(*settings.exempt_countries)


def is_country_level() -> Column:
    return F.col("host") == DEFAULT


def is_host_level() -> Column:
    """A missing host is a host."""
    return F.col("host").isNull() | (F.col("host") != DEFAULT)


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def exact_revenue(revenue: Column) -> Column:
    """Revenue as a decimal of ten places, half-up, so that its sum is the same in any order.

    A decimal of up to ten places and 18 digits before the point keeps its value; a double is
    converted here, once per event.
    """
    return revenue.cast("decimal(28,10)")


def counter_columns(settings: Settings) -> list[Column]:
    """Row-level, null-free counters. ``clean_`` and top bids count error-free rows only."""
    clean = F.col("error_code").isNull()
    sources = {
        "bids": F.col("bids"),
        "requests": F.col("bid_requests"),
        "clean_requests": F.when(clean, F.col("bid_requests")),
        "opportunities": F.col("bid_opportunities"),
        "top_bids": F.when(clean, F.col("total_top_bids")),
        "revenue": exact_revenue(F.col("estimated_adjusted_revenue")),
    }
    return [or_zero(sources[name]).alias(name) for name in settings.measures]


def sums(settings: Settings) -> list[Column]:
    return [F.sum(name).alias(name) for name in settings.measures]


def percent(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part), F.col(whole)) * 100


def metric_columns(settings: Settings) -> list[Column]:
    """Metrics of a group whose counters are already summed; NULL where the divisor is 0.

    Revenue stays a decimal until here, so its sum is the same in any order.
    """
    volume = F.col(settings.volume).alias("volume")
    top_bid_rate = F.round(percent("top_bids", settings.rate_base), 2).alias("top_bid_rate")
    if not settings.refined:
        return [F.col("bids"), volume, F.col("top_bids"), top_bid_rate]
    revenue = F.col("revenue").cast("double")
    return [
        F.col("bids"),
        volume,
        revenue.alias("revenue"),
        (F.try_divide(revenue, F.col("opportunities")) * 1000).alias("rpr"),
        percent("bids", "opportunities").alias("bid_rate"),
        F.col("top_bids"),
        top_bid_rate,
    ]


def volume_class(volume: Column, settings: Settings) -> Column:
    return F.when(volume > settings.min_requests, HIGH).otherwise(LOW)


def collapsed_country(settings: Settings) -> Column:
    """Key of the row a low-volume group is merged into."""
    return F.when(is_exempt(settings), F.col("country")).otherwise(DEFAULT)
