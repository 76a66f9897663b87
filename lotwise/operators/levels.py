"""Country and host rates in one relation, without hosts that repeat their country's rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.measures import is_country_level, is_host_level
from lotwise.operators.counters import COUNTRY_KEYS, HOST_KEYS
from lotwise.settings import DEFAULT, Settings

# Parts that the hosts of one bidder and country are spread over to meet their country's row.
SALTS = 16


def union_levels(countries: DataFrame, hosts: DataFrame, settings: Settings) -> DataFrame:
    columns = [*HOST_KEYS, "volume", "top_bid_rate", "thr"]
    if settings.refined:
        columns += ["revenue", "bid_rate", "rpr"]
    columns.append("rate")
    return countries.withColumn("host", F.lit(DEFAULT)).select(columns).unionByName(
        hosts.select(columns)
    )


def counted_countries(countries: DataFrame) -> DataFrame:
    """Country rows with ``repeats``, the number of rows of their key."""
    same_key = Window.partitionBy(*COUNTRY_KEYS)
    return countries.withColumn("repeats", F.count(F.lit(1)).over(same_key))


def repeated_countries(countries: DataFrame) -> DataFrame:
    """Counted country rows as often as there are rows of their key: comparing each with the
    country rows of its key, as hosts are compared, multiplies a repeated one."""
    copy = F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))
    return countries.withColumn("_copy", copy).drop("repeats", "_copy")


def differing_hosts(
    hosts: DataFrame, countries: DataFrame, rate: str = "rate", salts: int = SALTS
) -> DataFrame:
    """Host rows whose rate differs from a rate of their country.

    A host without a country row is dropped. The hosts of a bidder and country are spread over
    ``salts`` parts, each of which meets a copy of the country row, so that a country holding a
    third of all hosts is not one task; country rows are few beside hosts. ``countries`` may be a
    written table: its size is then known beforehand, and while that is below the broadcast
    threshold hosts need no shuffle.
    """
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    parents = countries.select(*COUNTRY_KEYS, F.col(rate).alias("parent_rate"), copies)
    salted = hosts.withColumn("_salt", F.pmod(F.hash("host"), F.lit(salts)))
    met = salted.join(parents, [*COUNTRY_KEYS, "_salt"])
    return met.filter(F.col(rate) != F.col("parent_rate")).drop("parent_rate", "_salt")


def drop_redundant_hosts(levels: DataFrame, rate: str = "rate") -> DataFrame:
    """Country rows, and host rows whose rate differs from their country's.

    Rows with the host ``default`` are country rows, whatever level they come from.
    """
    countries = counted_countries(levels.filter(is_country_level()))
    hosts = differing_hosts(levels.filter(is_host_level()), countries, rate)
    return repeated_countries(countries).unionByName(hosts)
