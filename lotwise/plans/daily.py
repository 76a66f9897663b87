"""Runs of successive days: each reads the events of the newest day and sums of the days before."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from lotwise.plans.rate_table import rates_of
from lotwise.settings import Settings
from lotwise.sources.events import check_columns
from lotwise.sources.rollups import add_days, missing_days, rollup_rows

# Given days, the events of at least these.
DayReader = Callable[[list[date]], DataFrame]


def refresh_rollup(
    spark: SparkSession, read: DayReader, store: str, settings: Settings, again: Iterable[date] = ()
) -> list[date]:
    """Sum the days of the long window that the store lacks, and the days ``again``, whose events
    have changed since. Returns the days that were read; on a daily schedule that is the newest."""
    wanted = set(missing_days(spark, store, settings)) | (set(again) & set(settings.days))
    days = sorted(wanted)
    if days:
        events = check_columns(read(days), settings)
        add_days(events, store, settings, days)
    return days


def daily_rate_table(
    spark: SparkSession, read: DayReader, store: str, settings: Settings, again: Iterable[date] = ()
) -> DataFrame:
    """The rows of ``rate_table`` over the long window, from a store that is brought up to date."""
    refresh_rollup(spark, read, store, settings, again)
    return rates_of(rollup_rows(spark, store, settings), settings)
