"""The rate table: events in, (bidder, continent, country, host, filter) out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.measures import is_country_level, is_host_level
from lotwise.operators.counters import HOST_KEYS, HOST_PLACE, PLACE, base_rollup, counters
from lotwise.operators.entries import host_entries, treated_entries
from lotwise.operators.levels import (
    counted_countries,
    differing_hosts,
    repeated_countries,
    union_levels,
)
from lotwise.operators.rates import country_rates, host_rates, refine_rates
from lotwise.operators.thresholds import BIDDER_COLUMNS, bidder_thresholds, by_bidder, thresholds
from lotwise.settings import DEFAULT, Settings
from lotwise.sources.events import check_columns
from lotwise.sources.staging import stage


def rate_levels(treated: DataFrame, hosts: DataFrame, settings: Settings) -> DataFrame:
    """Rates of both levels, before redundant hosts are dropped."""
    countries = country_rates(thresholds(treated, PLACE, settings, repeated_keys=True), settings)
    own = host_rates(thresholds(hosts, HOST_PLACE, settings), settings)
    levels = union_levels(countries, own, settings)
    return refine_rates(levels, settings) if settings.refined else levels


def _host_filters(hosts: DataFrame, settings: Settings) -> DataFrame:
    rates = host_rates(thresholds(hosts, HOST_PLACE, settings), settings)
    return _filters(rates, settings)


def _filters(rates: DataFrame, settings: Settings) -> DataFrame:
    if settings.refined:
        rates = refine_rates(rates, settings)
    rate = "refined_rate" if settings.refined else "rate"
    return rates.select(*HOST_KEYS, F.col(rate).alias("filter"))


def rate_table(events: DataFrame, settings: Settings) -> DataFrame:
    """The whole job on one scan of the events; see ``rates_of``."""
    check_columns(events, settings)
    return rates_of(counters(events, settings), settings)


def rates_of(rows: DataFrame, settings: Settings) -> DataFrame:
    """The rates from counters or from any partial sums of them.

    Calling it runs jobs: three tables are written on the way, which the result reads. The rollup,
    which both levels start from instead of the rows; the entries of both levels, which leave
    out hosts below the volume cut, no file of which mixes levels; and the finished country rows,
    so that only host rows are left to be joined with them. ``freed_staging`` removes them after
    use.
    """
    rollup = stage(base_rollup(rows, settings), "rollup")
    entries = stage(
        by_bidder(treated_entries(rollup, settings), PLACE, settings)
        .withColumn("level", F.lit("country"))
        .unionByName(
            host_entries(rollup, settings, rolled_up=True)
            .drop("bids", "top_bids")
            .withColumn("level", F.lit("host")),
            allowMissingColumns=True,
        ),
        "entries",
    )
    treated = entries.filter(F.col("level") == "country").drop("host", "level")
    hosts = entries.filter(F.col("level") == "host").drop("level", *BIDDER_COLUMNS)

    by_country = country_rates(bidder_thresholds(treated, PLACE), settings)
    own = _filters(by_country.withColumn("host", F.lit(DEFAULT)), settings)
    # A raw host spelled like a country row counts as one.
    spelled = _host_filters(hosts.filter(is_country_level()), settings)
    countries = stage(counted_countries(own.unionByName(spelled)), "countries")
    named = _host_filters(hosts.filter(is_host_level()), settings)
    return repeated_countries(countries).unionByName(differing_hosts(named, countries, "filter"))


def in_key_order(rates: DataFrame) -> DataFrame:
    """Ascending keys, NULL host first. For sinks only; nothing downstream relies on it."""
    return rates.orderBy(*HOST_KEYS)


def in_place_order(rates: DataFrame) -> DataFrame:
    """Best bidder of each place first, for reading; NULL rates last."""
    return rates.orderBy(*PLACE, F.col("top_bid_rate").desc(), "bidder")
