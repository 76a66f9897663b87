"""Run the job: ``python -m lotwise --events PATH --out FOLDER``."""

from __future__ import annotations

import argparse
import logging
from datetime import date
from functools import partial

from pyspark.sql import SparkSession

from lotwise.plans.daily import daily_rate_table
from lotwise.plans.publish import publish, publish_rates
from lotwise.settings import MIN_REQUESTS, basic, refined, utc_today
from lotwise.sources.events import day_events, read_events, table_day_events, table_events
from lotwise.sources.file_index import read_indexed_events
from lotwise.sources.requests import parse_request
from lotwise.sources.staging import freed_staging


def bands(text: str) -> tuple[tuple[float, float], ...]:
    pairs = (pair.split("=") for pair in text.split(","))
    return tuple((float(floor), float(rate)) for floor, rate in pairs)


def main(argv: list[str] | None = None) -> str:
    parser = argparse.ArgumentParser(prog="lotwise", description="Publish traffic rates.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--events", help="folder of the Parquet event table")
    source.add_argument("--table", help="event table of the catalog")
    parser.add_argument("--out", required=True, help="folder the document is written under")
    parser.add_argument("--rates", help="also write the flat rate table here")
    parser.add_argument("--variant", choices=("basic", "refined"), default="basic")
    parser.add_argument("--as-of", type=date.fromisoformat, default=utc_today())
    parser.add_argument("--min-requests", type=int, default=MIN_REQUESTS)
    parser.add_argument("--extended-days", type=int, help="days of the long window")
    parser.add_argument("--default-rate", type=float)
    parser.add_argument("--bands", type=bands, help="from high to low, such as 75=1,50=0.75")
    parser.add_argument("--min-rpr", type=float)
    parser.add_argument("--files", type=int, help="publish a folder of up to this many files")
    parser.add_argument("--day-column", help="DATE partition column of the event table")
    parser.add_argument("--index", help="folder of an index of event files, without a day column")
    parser.add_argument("--rollup", help="folder of daily sums; only days it lacks are read")
    parser.add_argument(
        "--again", type=date.fromisoformat, action="append", default=[],
        help="day of the window to be summed again into the rollup, such as 2026-01-04",
    )
    parser.add_argument("--request", help='JSON options: {"override": {...}, "filename": "..."}')
    args = parser.parse_args(argv)
    if args.index and (args.table or args.day_column or args.rollup):
        parser.error("--index is for --events without --day-column and --rollup")

    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("lotwise").getOrCreate()
    preset = {"basic": basic, "refined": refined}[args.variant]
    names = ("extended_days", "default_rate", "bands", "min_rpr")
    given = {name: getattr(args, name) for name in names if getattr(args, name) is not None}
    settings = preset(as_of=args.as_of, min_requests=args.min_requests, **given)
    request = parse_request(args.request)
    place = args.table or args.events
    if args.rollup:
        read_days = table_day_events if args.table else day_events
        read = partial(read_days, spark, place, day_column=args.day_column)
        with freed_staging(spark):
            rates = daily_rate_table(spark, read, args.rollup, settings, args.again)
            return publish_rates(rates, args.out, request, args.rates, files=args.files)
    if args.index:
        events = read_indexed_events(spark, place, args.index, settings)
    else:
        read = table_events if args.table else read_events
        events = read(spark, place, settings, args.day_column)
    return publish(events, settings, args.out, request, args.rates, files=args.files)


if __name__ == "__main__":
    main()
