"""Ordered rules: the first condition that holds decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.settings import TOP_BID_RATE_FLOOR, Settings
from lotwise.functions.measures import is_exempt

Rule = tuple[Column, float]


def first_match(rules: Sequence[Rule], otherwise: Column | float) -> Column:
    """A condition that is NULL does not hold. All results are doubles."""
    chain = F
    for condition, rate in rules:
        chain = chain.when(condition, F.lit(float(rate)))
    return chain.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(float(otherwise)))


def _exempt(settings: Settings) -> Rule:
    return is_exempt(settings), 0.0


def _no_method(settings: Settings) -> Rule:
    return F.col("method").isNull(), settings.default_rate


def _too_low(settings: Settings) -> list[Rule]:
    rate = F.col("top_bid_rate")
    return [
        (rate < TOP_BID_RATE_FLOOR, settings.default_rate),
        (rate < F.col("thr"), settings.default_rate),
    ]


def country_rules(settings: Settings) -> list[Rule]:
    rules = [_exempt(settings), _no_method(settings)]
    if settings.refined:
        idle = (
            (F.col("revenue") == 0.0)
            & (F.col("rpr") == 0.0)
            & (F.col("bid_rate") == 0.0)
            & F.col("top_bid_rate").isNull()
        )
        rules.append((idle, settings.default_rate))
    return rules + _too_low(settings)


def host_rules(settings: Settings) -> list[Rule]:
    if not settings.refined:
        return [_exempt(settings), _no_method(settings), *_too_low(settings)]
    trusted = (
        F.col("bidder").isin(*settings.exception_bidders)
        & (F.col("bid_rate") >= settings.lowest_band)
        & (F.col("rpr") >= settings.min_rpr)
    )
    unmeasured = F.col("top_bid_rate").isNull()
    return [
        _exempt(settings),
        (trusted, 1.0),
        _no_method(settings),
        (unmeasured, settings.default_rate),
        *_too_low(settings),
    ]


def refinement_rules(settings: Settings) -> list[Rule]:
    """Raise default rates that earn, by band of bid rate; lower full rates that do not."""
    earns = (F.col("rate") == settings.default_rate) & (F.col("rpr") > settings.min_rpr)
    full = F.col("rate") == 1.0
    idle = (
        (F.col("bid_rate") < settings.lowest_band)
        & (F.col("rpr") < settings.min_rpr)
        & (F.col("top_bid_rate") < TOP_BID_RATE_FLOOR)
    )
    # Bands run from high to low, so the first floor reached is the band.
    raised = [(earns & (F.col("bid_rate") >= floor), rate) for floor, rate in settings.bands]
    lowered = [
        (full & idle, settings.default_rate),
        (full & (F.col("rpr") == 0.0), settings.default_rate),
    ]
    return raised + lowered
