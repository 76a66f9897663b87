"""The whole run: rate table, validation, overrides, published document."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from lotwise.operators.document import (
    check_rates,
    distinct_leaves,
    document_lines,
    override_rows,
)
from lotwise.plans.rate_table import rate_table
from lotwise.settings import Settings
from lotwise.sources.requests import Request
from lotwise.sources.sinks import write_document, write_rates
from lotwise.sources.staging import freed_staging, stage

log = logging.getLogger(__name__)


def publish_rates(
    rates: DataFrame,
    folder: str,
    request: Request = Request(),
    rates_path: str | None = None,
    order_by: str | None = None,
    files: int | None = None,
) -> str:
    """Validate ``rates``, apply the request's override and write the document.

    Any five-column rate table will do; of rows with one key, the last by ``order_by`` counts.
    Nothing is written if a row is invalid or there is none; overrides are merged after
    validation and are not checked. The document is one file, or with ``files`` a folder of up to
    that many. Tables staged on the way are removed at the end, and kept if the run fails.
    """
    spark = rates.sparkSession
    path = f"{folder.rstrip('/')}/{request.filename}"
    with freed_staging(spark):
        rates = check_rates(stage(rates, "rates"))
        leaves = stage(distinct_leaves(rates, order_by), "leaves")
        overrides = override_rows(spark, request.override) if request.override else None
        if rates_path:
            write_rates(rates, rates_path)
        write_document(stage(document_lines(leaves, overrides), "lines"), path, files)
    log.info("wrote %s", path)
    return path


def publish(
    events: DataFrame,
    settings: Settings,
    folder: str,
    request: Request = Request(),
    rates_path: str | None = None,
    order_by: str | None = None,
    files: int | None = None,
) -> str:
    """The whole run on one scan of ``events``; options as for ``publish_rates``."""
    with freed_staging(events.sparkSession):
        rates = rate_table(events, settings)
        return publish_rates(rates, folder, request, rates_path, order_by, files)
