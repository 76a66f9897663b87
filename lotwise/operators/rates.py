"""Rates by ordered rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.rules import country_rules, first_match, host_rules, refinement_rules
from lotwise.settings import Settings


def country_rates(entries: DataFrame, settings: Settings) -> DataFrame:
    return entries.withColumn("rate", first_match(country_rules(settings), 1.0))


def host_rates(entries: DataFrame, settings: Settings) -> DataFrame:
    return entries.withColumn("rate", first_match(host_rules(settings), 1.0))


def refine_rates(levels: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``refined_rate``: the rate adjusted by bid rate and revenue."""
    return levels.withColumn("refined_rate", first_match(refinement_rules(settings), F.col("rate")))
