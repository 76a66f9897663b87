"""Hand-made events for Spark and, with the same rows, DuckDB."""

from datetime import datetime, timedelta, timezone
from decimal import Decimal

from lotwise.settings import basic, refined
from lotwise.sources.events import EVENT_SCHEMA
from lotwise_checks.fixtures import AS_OF
from lotwise_checks.oracles import Oracle

PRESETS = {"basic": basic, "refined": refined}
RAW = "SELECT * FROM raw_events"


def settings(variant, **changes):
    return PRESETS[variant](as_of=AS_OF, **changes)


def days_ago(days, seconds=0):
    start = datetime(AS_OF.year, AS_OF.month, AS_OF.day, tzinfo=timezone.utc)
    return start - timedelta(days=days) + timedelta(seconds=seconds)


def event(
    bidder="b1",
    continent="EU",
    country="FR",
    host=None,
    requests=10_000,
    top=0,
    bids=0,
    revenue=0,
    offers=None,
    error=None,
    at=None,
):
    money = None if revenue is None else Decimal(str(revenue)).quantize(Decimal("0.0001"))
    offers = requests if offers is None else offers
    when = at or days_ago(1)
    return (bidder, continent, country, host, error, when, bids, requests, offers, top, money)


def frame(spark, events):
    return spark.createDataFrame(events, EVENT_SCHEMA)


def load_duck(con, events):
    con.execute(
        """CREATE OR REPLACE TABLE raw_events (bidder_id VARCHAR, geo_continent VARCHAR,
        geo_country VARCHAR, host VARCHAR, error_code VARCHAR, record_date TIMESTAMP, bids BIGINT,
        bid_requests BIGINT, bid_opportunities BIGINT, total_top_bids BIGINT,
        estimated_adjusted_revenue DECIMAL(18,4))"""
    )
    if events:
        plain = [(*e[:5], e[5].replace(tzinfo=None), *e[6:]) for e in events]
        con.executemany(f"INSERT INTO raw_events VALUES ({', '.join('?' * 11)})", plain)


def oracle(own):
    return Oracle(own, events=RAW)
