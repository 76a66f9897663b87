"""The rate table with one read of the events per branch, to compare the one-scan job with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.measures import collapsed_country, known_place, metric_columns, sums
from lotwise.operators.counters import COUNTRY_KEYS, HOST_KEYS, counters
from lotwise.operators.entries import country_entries, host_entries
from lotwise.operators.levels import drop_redundant_hosts
from lotwise.plans.rate_table import rate_levels
from lotwise.settings import HIGH, LOW, Settings
from lotwise.sources.events import check_columns
from lotwise.sources.staging import stage


def collapse_low_volume(rows: DataFrame, entries: DataFrame, settings: Settings) -> DataFrame:
    """The rows of ``treated_entries`` by a second read of the long window and a union.

    A semi-join keeps the groups that were low on the last day. Rows are summed per group before
    it, so a group holding much of the data reaches the join as one row. No broadcast hint: the
    number of groups follows the data, so the adaptive planner decides by the size it measures.
    """
    low_keys = entries.filter(F.col("volume_class") == LOW).select(*COUNTRY_KEYS)
    merged = (
        rows.filter(known_place())
        .groupBy(*COUNTRY_KEYS)
        .agg(*sums(settings))
        .join(low_keys, list(COUNTRY_KEYS), "left_semi")
        .withColumn("country", collapsed_country(settings))
        .groupBy(*COUNTRY_KEYS)
        .agg(*sums(settings))
        .select(*COUNTRY_KEYS, *metric_columns(settings))
    )
    high = entries.filter(F.col("volume_class") == HIGH).drop("volume_class")
    return merged.unionByName(high)


def rate_table_by_scans(events: DataFrame, settings: Settings) -> DataFrame:
    """The rows of ``rate_table`` from three scans: last-day countries, long window, hosts.

    Calling it runs jobs, as each branch is written before it is used.
    """
    check_columns(events, settings)
    rows = counters(events, settings)
    entries = stage(country_entries(rows, settings), "entries")
    treated = stage(collapse_low_volume(rows, entries, settings), "treated")
    hosts = stage(host_entries(rows, settings), "hosts")
    rate = "refined_rate" if settings.refined else "rate"
    kept = drop_redundant_hosts(stage(rate_levels(treated, hosts, settings), "levels"), rate)
    return kept.select(*HOST_KEYS, F.col(rate).alias("filter"))
