"""Metrics per bidder and place, with low-volume countries merged over the long window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.measures import (
    collapsed_country,
    known_place,
    metric_columns,
    sums,
    volume_class,
)
from lotwise.operators.counters import COUNTRY_KEYS, HOST_KEYS
from lotwise.settings import LOW, Settings


def _last_day_known(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("last_day") & known_place())


def country_entries(rows: DataFrame, settings: Settings) -> DataFrame:
    """Last-day metrics and volume class per bidder, continent and country."""
    return (
        _last_day_known(rows)
        .groupBy(*COUNTRY_KEYS)
        .agg(*sums(settings))
        .select(*COUNTRY_KEYS, *metric_columns(settings))
        .withColumn("volume_class", volume_class(F.col("volume"), settings))
    )


def treated_entries(rows: DataFrame, settings: Settings) -> DataFrame:
    """High last-day entries as they are; low ones re-summed over the long window and merged to one
    row per continent, exempt countries apart.

    Last-day and long-window sums are taken side by side per country, so no second read and no
    join are needed. Grouping by the class as well keeps a raw country spelled like the merged
    row's key apart from it.
    """
    def last_day_sum(name: str) -> Column:
        return F.sum(F.when(F.col("last_day"), F.col(name))).alias(f"{name}_day")

    totals = (
        rows.filter(known_place())
        .groupBy(*COUNTRY_KEYS)
        .agg(*sums(settings), *[last_day_sum(name) for name in settings.measures])
        # NULL: no row on the last day, hence no entry.
        .filter(F.col(f"{settings.volume}_day").isNotNull())
        .withColumn("volume_class", volume_class(F.col(f"{settings.volume}_day"), settings))
    )
    low = F.col("volume_class") == LOW
    return (
        totals.select(
            "bidder",
            "continent",
            F.when(low, collapsed_country(settings)).otherwise(F.col("country")).alias("country"),
            "volume_class",
            *[
                F.when(low, F.col(name)).otherwise(F.col(f"{name}_day")).alias(name)
                for name in settings.measures
            ],
        )
        .groupBy(*COUNTRY_KEYS, "volume_class")
        .agg(*sums(settings))
        .select(*COUNTRY_KEYS, *metric_columns(settings))
    )


def host_entries(rows: DataFrame, settings: Settings, rolled_up: bool = False) -> DataFrame:
    """Last-day metrics per bidder, place and host above the volume cut.

    A NULL host is a group, and unknown places are kept. On a ``rolled_up`` input each key is one
    row already, so there is nothing to shuffle.
    """
    day = rows.filter(F.col("last_day"))
    if not rolled_up:
        day = day.groupBy(*HOST_KEYS).agg(*sums(settings))
    volume = F.col(settings.volume)
    cut = settings.min_requests
    enough = volume >= cut if settings.host_cut_inclusive else volume > cut
    return day.filter(enough).select(*HOST_KEYS, *metric_columns(settings))
