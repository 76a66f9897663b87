"""Headline timings: prints one JSON line.

The auction events are first written once as Parquet, partitioned by day, as the table would be
stored; that is not timed. Each figure is the median of warm runs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from functools import partial
from pathlib import Path
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lotwise.operators.counters import counters  # noqa: E402
from lotwise.operators.document import fold_rates, unfold_rates  # noqa: E402
from lotwise.operators.entries import host_entries  # noqa: E402
from lotwise.plans.daily import daily_rate_table, refresh_rollup  # noqa: E402
from lotwise.plans.publish import publish_rates  # noqa: E402
from lotwise.plans.rate_table import rate_table  # noqa: E402
from lotwise.sources.documents import read_document  # noqa: E402
from lotwise.sources.events import day_events, read_events  # noqa: E402
from lotwise.sources.staging import stage  # noqa: E402
from lotwise_checks.comparison import rate_table_by_scans  # noqa: E402
from lotwise_checks.fixtures import bid_events, fixture_settings  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MEMORY = os.environ.get("BENCH_MEMORY", "8g")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", MEMORY)
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"{scratch}/staged")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    table = f"{scratch}/events"
    events = bid_events(spark, SF_DIR)
    events.withColumn("day", F.to_date("record_date")).write.partitionBy("day").parquet(table)

    timed, rows = {}, {}
    for variant in ("basic", "refined"):
        own = fixture_settings(variant)
        rows[f"host_entries_{variant}"] = host_entries(counters(events, own), own).count()
        published = stage(rate_table(events, own), "counted")
        rows[f"published_{variant}"] = published.count()
        hosts = published.filter("host IS NULL OR host <> 'default'")
        rows[f"published_hosts_{variant}"] = hosts.count()

        def scan(own=own) -> DataFrame:
            return read_events(spark, table, own, day_column="day")

        timed[f"rate_table_{variant}"] = lambda own=own, scan=scan: run(rate_table(scan(), own))
        timed[f"rate_table_by_scans_{variant}"] = lambda own=own, scan=scan: run(
            rate_table_by_scans(scan(), own)
        )
        # The run of a day whose events are new, on sums of the days before.
        read, store = partial(day_events, spark, table, day_column="day"), f"{scratch}/sums"
        refresh_rollup(spark, read, store, own)
        timed[f"rate_table_daily_{variant}"] = lambda own=own, read=read, store=store: run(
            daily_rate_table(spark, read, store, own, again=own.days[-1:])
        )
        timed[f"rate_table_from_raw_{variant}"] = lambda own=own: run(rate_table(events, own))
    rates = stage(rate_table(scan(), own), "rates")
    timed["fold"] = lambda: run(fold_rates(rates))
    timed["publish"] = lambda: publish_rates(rates, f"{scratch}/published")
    split = publish_rates(rates, f"{scratch}/split", files=8)
    timed["read_document"] = lambda: run(unfold_rates(read_document(spark, split)))

    seconds = {}
    for name, work in timed.items():
        work()
        laps = []
        for _ in range(RUNS):
            start = time.perf_counter()
            work()
            laps.append(time.perf_counter() - start)
        seconds[name] = round(median(laps), 3)
    spark.stop()

    headline = seconds["rate_table_basic"] + seconds["rate_table_refined"]
    print(
        json.dumps(
            {
                "metric": "rate tables, basic and refined, one scan each",
                "value": round(headline, 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
                "memory": MEMORY,
            }
        )
    )


if __name__ == "__main__":
    main()
