"""From raw events to counters, and the one-scan base rollup.

Counters and their rollup have the same columns and every measure is a sum, so each later step
gives the same result on either.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.measures import (
    counter_columns,
    in_window,
    known_place,
    sums,
    usable_error,
    utc_day,
)
from lotwise.settings import Settings
from lotwise.sources.events import EVENT_SCHEMA

PLACE = ("continent", "country")
COUNTRY_KEYS = ("bidder", *PLACE)
HOST_PLACE = (*PLACE, "host")
HOST_KEYS = (*COUNTRY_KEYS, "host")


def usable_events(events: DataFrame) -> DataFrame:
    """Events with a bidder, a place, and no error but the tolerated one."""
    return events.filter(
        F.col("bidder_id").isNotNull()
        & F.col("geo_continent").isNotNull()
        & F.col("geo_country").isNotNull()
        & usable_error(F.col("error_code"))
    )


def renamed_keys(events: DataFrame, *more: str) -> DataFrame:
    """The event columns the job knows, under short key names, and the columns ``more``; a wider
    table may use those names too."""
    short = {"bidder_id": "bidder", "geo_continent": "continent", "geo_country": "country"}
    known = [name for name in (*EVENT_SCHEMA.names, *more) if name in events.columns]
    return events.select([F.col(name).alias(short.get(name, name)) for name in known])


def valid_events(events: DataFrame) -> DataFrame:
    """Usable events whose place is known: what country-level metrics are made of."""
    return renamed_keys(usable_events(events)).filter(known_place())


def last_day(events: DataFrame, settings: Settings) -> DataFrame:
    return events.filter(in_window(F.col("record_date"), settings.day_start, settings.day_end))


def long_window(events: DataFrame, settings: Settings) -> DataFrame:
    return events.filter(in_window(F.col("record_date"), settings.long_start, settings.day_end))


def counters(events: DataFrame, settings: Settings) -> DataFrame:
    """One row per usable event of the long window: keys, ``last_day`` and the variant's measures.

    Hosts and unknown places matter on the last day only, so older rows drop both; the rollup of
    the older days is then one row per bidder and country.
    """
    recent = F.col("record_date") >= F.lit(settings.day_start)
    return (
        renamed_keys(usable_events(long_window(events, settings)))
        .filter(recent | known_place())
        .select(
            *COUNTRY_KEYS,
            F.when(recent, F.col("host")).alias("host"),
            recent.alias("last_day"),
            *counter_columns(settings),
        )
    )


def base_rollup(rows: DataFrame, settings: Settings) -> DataFrame:
    """Counters summed to one row per key and window part.

    Map-side partial sums shrink a hot key to one row per task before the shuffle.
    """
    return rows.groupBy(*HOST_KEYS, "last_day").agg(*sums(settings))


def conditional_sums(events: DataFrame, settings: Settings) -> DataFrame:
    """Null-as-zero and error-free sums of the last day per bidder and country."""
    rows = counters(last_day(events, settings), settings).filter(known_place())
    return rows.groupBy(*COUNTRY_KEYS).agg(*sums(settings))


def _within(days: Sequence[date]) -> Column:
    """Events from the first to the last of ``days``: a time window, which storage can prune by."""
    first, last = (datetime.combine(d, time(), timezone.utc) for d in (min(days), max(days)))
    return in_window(F.col("record_date"), first, last + timedelta(days=1))


def host_day_sums(events: DataFrame, settings: Settings, days: Sequence[date]) -> DataFrame:
    """The measures of ``days`` summed by UTC day, bidder, place and host, unknown places too."""
    rows = usable_events(events.filter(_within(days))).withColumn("day", utc_day(F.col("record_date")))
    rows = renamed_keys(rows.filter(F.col("day").isin(list(days))), "day")
    rows = rows.select(*HOST_KEYS, "day", *counter_columns(settings))
    return rows.groupBy("day", *HOST_KEYS).agg(*sums(settings))


def country_day_sums(host_sums: DataFrame, settings: Settings) -> DataFrame:
    """Sums by host added up by day, bidder and known place; the host is null."""
    summed = host_sums.filter(known_place()).groupBy("day", *COUNTRY_KEYS).agg(*sums(settings))
    host = F.lit(None).cast("string").alias("host")
    return summed.select(*COUNTRY_KEYS, host, *settings.measures, "day")
