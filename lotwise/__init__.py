"""Auction traffic rates on Spark."""

from lotwise.operators.document import check_rates, fold_rates, merge_overrides, override_rows
from lotwise.plans.publish import publish, publish_rates
from lotwise.plans.rate_table import rate_table
from lotwise.settings import Settings, basic, refined
from lotwise.sources.events import EVENT_SCHEMA, RATE_SCHEMA, read_events, table_events
from lotwise.sources.requests import Request, parse_request

__all__ = [
    "EVENT_SCHEMA",
    "RATE_SCHEMA",
    "Request",
    "Settings",
    "basic",
    "check_rates",
    "fold_rates",
    "merge_overrides",
    "override_rows",
    "parse_request",
    "publish",
    "publish_rates",
    "rate_table",
    "read_events",
    "refined",
    "table_events",
]
