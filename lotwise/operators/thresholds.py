"""Threshold method and threshold of a place. Country and host level differ in the key only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.settings import (
    FIXED,
    FIXED_THRESHOLD,
    MAX_FIXED_SPREAD,
    THRESHOLD_SHARE,
    TOP_BID_RATE_FLOOR,
    VARIABLE,
    Settings,
)

# What ``by_bidder`` gives for the statistics of places, beside the merged metrics.
BIDDER_COLUMNS = ("_entries", "_least", "_most", "_sum", "_rates")


def _above(rate: str) -> Column:
    return F.col(rate) > TOP_BID_RATE_FLOOR


def by_bidder(
    entries: DataFrame, place: Sequence[str], settings: Settings | None = None
) -> DataFrame:
    """One row per place and bidder, whatever the number of its entries: their number, what the
    statistics of the place need of them and, with ``settings``, their merged metrics.

    Volume and revenue are summed, rates are averaged. One aggregation serves both uses, if what
    it gives is written before ``bidder_thresholds`` reads it twice.
    """
    exact = F.col("top_bid_rate").cast("decimal(24,2)")
    rate = F.when(_above("top_bid_rate"), F.col("top_bid_rate"))
    summed, averaged = (["volume"], ["top_bid_rate"]) if settings else ([], [])
    if settings and settings.refined:
        summed.append("revenue")
        averaged += ["bid_rate", "rpr"]
    return entries.groupBy(*place, "bidder").agg(
        F.count(F.lit(1)).alias("_entries"),
        F.min(rate).alias("_least"),
        F.max(rate).alias("_most"),
        F.sum(exact).alias("_sum"),
        F.count(exact).alias("_rates"),
        *[F.sum(name).alias(name) for name in summed],
        *[F.avg(name).alias(name) for name in averaged],
    )


def _by_entry(entries: DataFrame) -> DataFrame:
    """The same of entries that are one a place and bidder."""
    rate = F.when(_above("top_bid_rate"), F.col("top_bid_rate"))
    exact = F.col("top_bid_rate").cast("decimal(24,2)")
    given = F.col("top_bid_rate").isNotNull().cast("int")
    return entries.withColumns({"_least": rate, "_most": rate, "_sum": exact, "_rates": given})


def _place_statistics(bidders: DataFrame, place: Sequence[str]) -> DataFrame:
    """Places with a bidder above the floor: spread, count and method over such bidders, and the
    mean over all entries.

    One aggregation gives all four, combined map-side, so a place with very many bidders is never
    one task's window. Rates have two decimals, so they are summed as decimals: the mean does not
    depend on the order in which tasks finish.
    """
    method = F.when(F.col("spread") > MAX_FIXED_SPREAD, VARIABLE).otherwise(FIXED)
    return (
        bidders.groupBy(*place)
        .agg(
            F.round(F.max("_most") - F.min("_least"), 1).alias("spread"),
            F.count("_most").alias("bidders_above"),
            (F.sum("_sum").cast("double") / F.sum("_rates")).alias("mean_rate"),
        )
        .filter(F.col("spread").isNotNull())
        .withColumn("method", method)
    )


def threshold_method(
    entries: DataFrame, place: Sequence[str], repeated_keys: bool = False
) -> DataFrame:
    """Method of each place that has a bidder above the floor."""
    bidders = by_bidder(entries, place) if repeated_keys else _by_entry(entries)
    return _place_statistics(bidders, place).drop("mean_rate")


def bidder_thresholds(bidders: DataFrame, place: Sequence[str]) -> DataFrame:
    """Entries given ``by_bidder`` with their place's method and threshold, each as often as it
    was there."""
    met = bidders.join(_place_statistics(bidders, place), list(place), "left")
    if "_entries" in bidders.columns:
        copy = F.explode(F.sequence(F.lit(1), F.col("_entries").cast("int")))
        met = met.withColumn("_entries", copy)
    variable = F.round(F.col("mean_rate") * THRESHOLD_SHARE, 0)
    threshold = F.when(F.col("method") == VARIABLE, variable).otherwise(F.lit(FIXED_THRESHOLD))
    return met.withColumn("thr", threshold).drop(*BIDDER_COLUMNS, "mean_rate", "bids", "top_bids")


def thresholds(
    entries: DataFrame, place: Sequence[str], settings: Settings, repeated_keys: bool = False
) -> DataFrame:
    """Entries with their place's method and threshold.

    A NULL host matches no place, so it has no method. With ``repeated_keys`` a bidder may have
    several entries in a place: at country level a raw country may be spelled like the merged
    low-volume row, giving two rows. Their metrics are merged, and both rows stay. Host entries are
    unique and do without that.
    """
    bidders = by_bidder(entries, place, settings) if repeated_keys else _by_entry(entries)
    return bidder_thresholds(bidders, place)
