
from __future__ import annotations

import importlib.util
import sys
from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import cached_property, partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lotwise.functions.measures import metric_columns, utc_day  # noqa: E402
from lotwise.operators.counters import (  # noqa: E402
    HOST_KEYS,
    HOST_PLACE,
    PLACE,
    base_rollup,
    conditional_sums,
    counters,
    last_day,
    long_window,
    valid_events,
)
from lotwise.operators.document import (  # noqa: E402
    distinct_leaves,
    document_lines,
    fold_rates,
    merge_overrides,
    override_rows,
    rate_violations,
    unfold_rates,
)
from lotwise.operators.entries import (  # noqa: E402
    country_entries,
    host_entries,
    treated_entries,
)
from lotwise.operators.levels import drop_redundant_hosts, union_levels  # noqa: E402
from lotwise.operators.rates import country_rates, host_rates, refine_rates  # noqa: E402
from lotwise.operators.thresholds import threshold_method, thresholds  # noqa: E402
from lotwise.plans.daily import DayReader, daily_rate_table, refresh_rollup  # noqa: E402
from lotwise.plans.publish import publish  # noqa: E402
from lotwise.plans.rate_table import in_key_order, rate_table  # noqa: E402
from lotwise.settings import Settings, basic, refined  # noqa: E402
from lotwise.sources.documents import read_document  # noqa: E402
from lotwise.sources.events import day_events, read_events  # noqa: E402
from lotwise.sources.file_index import read_indexed_events  # noqa: E402
from lotwise.sources.requests import Request, parse_request  # noqa: E402
from lotwise.sources.rollups import rollup_rows  # noqa: E402
from lotwise.sources.sinks import write_rates  # noqa: E402
from lotwise.sources.staging import stage, staged_path  # noqa: E402
from lotwise_checks.comparison import collapse_low_volume, rate_table_by_scans  # noqa: E402
from lotwise_checks.fixtures import AS_OF, bid_events, fixture_settings  # noqa: E402
from lotwise_checks.oracles import Oracle  # noqa: E402

# The language-model subpackage and its pipeline are optional; an error inside them is not hidden.
if importlib.util.find_spec("lotwise.llm") and importlib.util.find_spec("corpus_pipeline"):
    from lotwise.llm import registry as llm  # noqa: E402
else:
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
VARIANTS = ("basic", "refined")
PRESETS = {"basic": basic, "refined": refined}

# Overrides of several shapes: a scalar, a known bidder, a new bidder.
OVERRIDE = '{"site.example": 1.0, "bidder_2": {"EUROPE": {"default": 0.5, "RU": {"default": 0}}}}'
OVERRIDE_LEAVES = (
    "('site.example', NULL, NULL, NULL, 1.0::DOUBLE),"
    " ('bidder_2', 'EUROPE', 'default', 'default', 0.5),"
    " ('bidder_2', 'EUROPE', 'RU', 'default', 0.0)"
)

REQUEST = '{"filename": "rates.json", "minBidRate": "5", "override": ' + OVERRIDE + "}"
# Parts of every bidder's document, and files of the published one.
DOCUMENT_PARTS = 8
# Files of events stored by time.
EVENT_FILES = 16

Query = Callable[[SparkSession, str], DataFrame]


class Steps:
    """The named relations of one run over the fixture events, each built on the one before.

    ``rows`` are the events' counters, for relations that read them once. Relations that need them
    several times start from ``rollup``, so the base tables are joined and scanned once per query.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, variant: str) -> None:
        self.spark = spark
        self.settings: Settings = fixture_settings(variant)
        self.events = bid_events(spark, sf_dir)
        self.rows = counters(self.events, self.settings)

    @cached_property
    def rollup(self) -> DataFrame:
        return stage(base_rollup(self.rows, self.settings), "rollup")

    @cached_property
    def treated(self) -> DataFrame:
        return stage(treated_entries(self.rows, self.settings), "treated")

    @cached_property
    def staged_rates(self) -> DataFrame:
        return stage(rate_table(self.events, self.settings), "rates")

    def base_rollup(self) -> DataFrame:
        rollup = base_rollup(self.rows, self.settings)
        if self.settings.refined:
            rollup = rollup.withColumn("revenue", F.col("revenue").cast("double"))
        return rollup

    def conditional_sums(self) -> DataFrame:
        sums = conditional_sums(self.events, self.settings)
        if self.settings.refined:
            sums = sums.withColumn("revenue", F.col("revenue").cast("double"))
        return sums

    def ratio_metrics(self) -> DataFrame:
        day = base_rollup(self.rows, self.settings).filter("last_day")
        metrics = day.select(*HOST_KEYS, *metric_columns(self.settings))
        ratios = ["rpr", "bid_rate"] if self.settings.refined else []
        return metrics.select(*HOST_KEYS, *ratios, "top_bid_rate")

    def country_entries(self) -> DataFrame:
        return country_entries(self.rows, self.settings)

    def low_volume_collapse(self) -> DataFrame:
        entries = country_entries(self.rollup, self.settings)
        return collapse_low_volume(self.rollup, entries, self.settings)

    def treated_entries(self) -> DataFrame:
        return treated_entries(self.rows, self.settings)

    def threshold_method(self) -> DataFrame:
        return threshold_method(self.treated, PLACE, repeated_keys=True)

    def country_thresholds(self) -> DataFrame:
        return thresholds(self.treated, PLACE, self.settings, repeated_keys=True)

    def country_rates(self) -> DataFrame:
        return country_rates(self.country_thresholds(), self.settings)

    def host_entries(self) -> DataFrame:
        return host_entries(self.rows, self.settings)

    def host_threshold_method(self) -> DataFrame:
        return threshold_method(self.host_entries(), HOST_PLACE)

    def host_thresholds(self) -> DataFrame:
        entries = host_entries(self.rollup, self.settings, rolled_up=True)
        return thresholds(entries, HOST_PLACE, self.settings)

    def host_rates(self) -> DataFrame:
        return host_rates(self.host_thresholds(), self.settings)

    def union_levels(self) -> DataFrame:
        return union_levels(self.country_rates(), self.host_rates(), self.settings)

    def refine_rates(self) -> DataFrame:
        return refine_rates(self.union_levels(), self.settings)

    def drop_redundant_hosts(self) -> DataFrame:
        if self.settings.refined:
            return drop_redundant_hosts(self.refine_rates(), "refined_rate")
        return drop_redundant_hosts(self.union_levels())

    def rate_table(self) -> DataFrame:
        rates = rate_table(self.events, self.settings)
        return rates if self.settings.refined else in_key_order(rates)

    def rate_table_by_scans(self) -> DataFrame:
        return rate_table_by_scans(self.events, self.settings)

    def _after_yesterday(self) -> tuple[DayReader, str]:
        """A reader of events stored by day, and daily sums as yesterday's run left them."""
        path, store = (staged_path(self.spark, name) for name in ("events", "sums"))
        by_day = self.events.withColumn("day", utc_day(F.col("record_date")))
        by_day.write.partitionBy("day").parquet(path)
        read = partial(day_events, self.spark, path, day_column="day")
        yesterday = replace(self.settings, as_of=self.settings.as_of - timedelta(days=1))
        refresh_rollup(self.spark, read, store, yesterday)
        return read, store

    def daily_sums(self) -> DataFrame:
        read, store = self._after_yesterday()
        refresh_rollup(self.spark, read, store, self.settings)
        rows = rollup_rows(self.spark, store, self.settings)
        if self.settings.refined:
            rows = rows.withColumn("revenue", F.col("revenue").cast("double"))
        return rows

    def rate_table_daily(self) -> DataFrame:
        read, store = self._after_yesterday()
        return daily_rate_table(self.spark, read, store, self.settings)

    def rate_leaves(self) -> DataFrame:
        return unfold_rates(fold_rates(self.staged_rates, parts=DOCUMENT_PARTS))

    def rate_document(self) -> DataFrame:
        folded = fold_rates(self.staged_rates, parts=DOCUMENT_PARTS)
        return folded.withColumn("document", F.to_json("document"))

    def document_lines(self) -> DataFrame:
        return document_lines(stage(distinct_leaves(self.staged_rates), "leaves"))

    def override_merge(self) -> DataFrame:
        documents = fold_rates(self.staged_rates, parts=DOCUMENT_PARTS)
        overrides = override_rows(documents.sparkSession, OVERRIDE)
        return unfold_rates(merge_overrides(documents, overrides))

    def _published(self, request: Request) -> DataFrame:
        """What is published under a request, written as a folder, read back and flattened."""
        folder = staged_path(self.spark, "published")
        path = publish(self.events, self.settings, folder, request, files=DOCUMENT_PARTS)
        return unfold_rates(read_document(self.spark, path))

    def published_document(self) -> DataFrame:
        return self._published(Request())

    def requested_document(self) -> DataFrame:
        """The same for a request as it is received, with an override."""
        return self._published(parse_request(REQUEST))

    def flat_rates(self) -> DataFrame:
        path = staged_path(self.spark, "flat")
        write_rates(self.staged_rates, path)
        return self.spark.read.parquet(path)

    def windowed_events(self) -> DataFrame:
        """Events stored by day and read as the job reads them."""
        path = staged_path(self.spark, "events")
        by_day = self.events.withColumn("day", F.to_date("record_date"))
        by_day.write.partitionBy("day").parquet(path)
        return self._timed(read_events(self.spark, path, self.settings, day_column="day"))

    def indexed_events(self) -> DataFrame:
        """Events stored by time without a day column, read by an index of their files."""
        path, index = (staged_path(self.spark, name) for name in ("events", "index"))
        self.events.repartitionByRange(EVENT_FILES, "record_date").write.parquet(path)
        return self._timed(read_indexed_events(self.spark, path, index, self.settings))

    def rate_violations(self) -> DataFrame:
        """Candidate rates straight from events, which break every row rule."""
        candidates = self.events.select(
            F.col("bidder_id").alias("bidder"),
            F.col("geo_continent").alias("continent"),
            F.when(F.col("geo_country") == "nan", "")
            .when(F.col("geo_country") == "RU", "default")
            .otherwise(F.col("geo_country"))
            .alias("country"),
            "host",
            (F.col("bids") - F.col("total_top_bids")).cast("double").alias("filter"),
        )
        return rate_violations(candidates).drop("example")

    def valid_events(self) -> DataFrame:
        events = valid_events(self.events)
        revenue = F.col("estimated_adjusted_revenue").cast("double").alias("revenue")
        return events.select(
            *HOST_KEYS,
            "error_code",
            "bids",
            "bid_requests",
            "bid_opportunities",
            "total_top_bids",
            revenue,
        )

    def last_day_events(self) -> DataFrame:
        return self._timed(last_day(self.events, self.settings))

    def long_window_events(self) -> DataFrame:
        return self._timed(long_window(self.events, self.settings))

    @staticmethod
    def _timed(events: DataFrame) -> DataFrame:
        return events.select(
            "bidder_id",
            "geo_continent",
            "geo_country",
            "host",
            "error_code",
            F.unix_seconds("record_date").alias("record_second"),
            "bids",
            "bid_requests",
        )


# Query name -> (method of Steps, variant).
SINGLE = {
    "valid_events": "basic",
    "last_day_events": "basic",
    "override_merge": "refined",
    "rate_violations": "basic",
    "refine_rates": "refined",
}
BOTH = (
    "long_window_events",
    "base_rollup",
    "conditional_sums",
    "ratio_metrics",
    "country_entries",
    "low_volume_collapse",
    "treated_entries",
    "threshold_method",
    "country_thresholds",
    "country_rates",
    "host_entries",
    "host_threshold_method",
    "host_thresholds",
    "host_rates",
    "union_levels",
    "drop_redundant_hosts",
    "rate_table",
    "rate_table_by_scans",
    "daily_sums",
    "rate_table_daily",
    "rate_leaves",
    "rate_document",
    "document_lines",
    "published_document",
    "requested_document",
    "flat_rates",
    "windowed_events",
    "indexed_events",
)


def _names() -> dict[str, tuple[str, str]]:
    names = {name: (name, variant) for name, variant in SINGLE.items()}
    names |= {f"{name}_{v}": (name, v) for name in BOTH for v in VARIANTS}
    return names


def _query(method: str, variant: str) -> Query:
    return lambda spark, sf_dir: getattr(Steps(spark, sf_dir, variant), method)()


def entry(spark: SparkSession) -> DataFrame:
    """The basic rate table on the smallest scale."""
    return Steps(spark, SMOKE_DIR, "basic").rate_table()


def rate_queries() -> dict[str, Query]:
    return {name: _query(method, variant) for name, (method, variant) in _names().items()}


def queries() -> dict[str, Query]:
    return rate_queries() | (llm.QUERIES if llm else {})


def _oracle(method: str, variant: str) -> str:
    oracle = Oracle(PRESETS[variant](as_of=AS_OF))
    own = {
        "valid_events": oracle.valid_events,
        "last_day_events": lambda: oracle.events_in(last_day_only=True),
        "long_window_events": lambda: oracle.events_in(last_day_only=False),
        "windowed_events": lambda: oracle.events_in(last_day_only=False),
        "indexed_events": lambda: oracle.events_in(last_day_only=False),
        "base_rollup": oracle.base_rollup,
        "daily_sums": oracle.daily_sums,
        "conditional_sums": oracle.conditional_sums,
        "ratio_metrics": oracle.ratio_metrics,
        "rate_violations": oracle.violations,
        "override_merge": lambda: oracle.overridden(("site.example", "bidder_2"), OVERRIDE_LEAVES),
        "requested_document": lambda: oracle.overridden(("site.example", "bidder_2"), OVERRIDE_LEAVES),
        "rate_document": lambda: oracle.documents(DOCUMENT_PARTS),
        "document_lines": oracle.document_lines,
    }
    if method in own:
        return own[method]()
    steps = {
        "country_entries": "entries",
        "low_volume_collapse": "treated",
        "treated_entries": "treated",
        "threshold_method": "methods",
        "host_entries": "hosts",
        "host_threshold_method": "host_methods",
        "union_levels": "levels",
        "refine_rates": "refined",
        "drop_redundant_hosts": "kept",
        "rate_table": "rates",
        "rate_table_by_scans": "rates",
        "rate_table_daily": "rates",
        "rate_leaves": "leaves",
        "published_document": "leaves",
        "flat_rates": "rates",
    }
    return oracle.select(steps.get(method, method))


def rate_oracle_sql() -> dict[str, str]:
    return {name: _oracle(method, variant) for name, (method, variant) in _names().items()}


def oracle_sql() -> dict[str, str]:
    return rate_oracle_sql() | (llm.ORACLES if llm else {})
