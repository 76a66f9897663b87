"""Runs of successive days from the store of daily sums."""

import json
from dataclasses import replace
from datetime import date, timedelta
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from events import AS_OF, days_ago, event, frame, settings
from lotwise.__main__ import main
from lotwise.plans import daily
from lotwise.plans.daily import daily_rate_table, refresh_rollup
from lotwise.plans.rate_table import rate_table
from lotwise.sources import rollups
from lotwise.sources.events import EVENT_SCHEMA, day_events, table_day_events
from lotwise.sources.rollups import IncompleteRollup, missing_days, rollup_root, rollup_rows
from test_random_events import random_events

VARIANTS = ["basic", "refined"]


def stored(spark, path, events):
    """Events by UTC day, and a day beside the window that cannot be read."""
    by_day = frame(spark, events).withColumn("day", F.to_date("record_date"))
    by_day.write.partitionBy("day").parquet(path)
    broken = Path(path) / "day=2019-05-05"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("no table")
    return partial(day_events, spark, path, day_column="day")


def spoil(path, keep):
    """Leave no readable file in the folders of days other than ``keep``."""
    for folder in Path(path).glob("day=*"):
        if folder.name != f"day={keep.isoformat()}":
            for file in folder.iterdir():
                file.write_text("no table")


def same(df, other):
    assert sorted(df.collect(), key=str) == sorted(other.collect(), key=str)


def run_of(own, days):
    return replace(own, as_of=own.as_of + timedelta(days=days))


@pytest.mark.parametrize("variant", VARIANTS)
@pytest.mark.parametrize("seed", range(3))
def test_successive_days_give_the_rows_of_whole_runs(spark, tmp_path, seed, variant):
    path, store = str(tmp_path / "events"), str(tmp_path / "sums")
    events = random_events(seed, collide=True)
    read = stored(spark, path, events)
    today = settings(variant, min_requests=400)
    yesterday = run_of(today, -1)
    whole = frame(spark, events)
    first = daily_rate_table(spark, read, store, yesterday)
    same(first, rate_table(whole, yesterday))
    assert missing_days(spark, store, today) == [date(2026, 1, 5)]
    # The second run can read the events of the newest day only.
    spoil(path, date(2026, 1, 5))
    same(daily_rate_table(spark, read, store, today), rate_table(whole, today))
    # The third has nothing left to read.
    spoil(path, date(2020, 1, 1))
    assert refresh_rollup(spark, read, store, today) == []
    same(daily_rate_table(spark, read, store, today), rate_table(whole, today))


def test_only_host_sums_of_the_last_day_are_read(spark, tmp_path):
    events = [event(host=f"h{n}.com", at=days_ago(1 + n % 5)) for n in range(40)]
    own, store = settings("basic"), str(tmp_path / "sums")
    refresh_rollup(spark, stored(spark, str(tmp_path / "events"), events), store, own)
    rows = rollup_rows(spark, store, own)
    files = {f.split("day=")[1].split("/part")[0] for f in rows.inputFiles()}
    older = {f"2026-01-0{n}/level=country" for n in range(1, 5)}
    assert files == older | {"2026-01-05/level=host"}
    assert rows.filter("NOT last_day").count() == 4
    assert rows.filter("last_day").count() == 8


def test_wider_last_day_windows_read_more_host_sums(spark, tmp_path):
    events = random_events(11, collide=False)
    own = settings("refined", min_requests=400, lookback_days=3)
    read = stored(spark, str(tmp_path / "events"), events)
    same(daily_rate_table(spark, read, str(tmp_path / "sums"), own), rate_table(frame(spark, events), own))


def test_a_day_without_events_is_summed_once(spark, tmp_path):
    own, store = settings("basic"), str(tmp_path / "sums")
    read = stored(spark, str(tmp_path / "events"), [event(at=days_ago(3))])
    assert len(refresh_rollup(spark, read, store, own)) == 5
    assert refresh_rollup(spark, read, store, own) == []
    empty = str(tmp_path / "none")
    refresh_rollup(spark, lambda days: spark.createDataFrame([], EVENT_SCHEMA), empty, own)
    assert missing_days(spark, empty, own) == []
    assert rollup_rows(spark, empty, own).collect() == []
    assert daily_rate_table(spark, read, empty, own).collect() == []


def test_a_restated_day_replaces_its_sums(spark, tmp_path):
    own, store = settings("basic"), str(tmp_path / "sums")
    early = [event(top=600, at=days_ago(n)) for n in (1, 2, 3)]
    late = [event(bidder="b2", requests=100, top=30, at=days_ago(n)) for n in (1, 2)]
    refresh_rollup(spark, lambda days: frame(spark, early), store, own)
    whole = frame(spark, early + late)
    seen = []
    again = [date(2026, 1, 4), date(2026, 1, 5), date(2011, 1, 1)]
    read = lambda days: seen.append(days) or whole
    same(daily_rate_table(spark, read, store, own, again), rate_table(whole, own))
    assert seen == [[date(2026, 1, 4), date(2026, 1, 5)]]


@pytest.mark.parametrize("zone", ["Pacific/Auckland", "America/Los_Angeles"])
def test_days_are_utc_days_in_any_session(spark, tmp_path, zone):
    events = random_events(5, collide=False)
    own, store = settings("refined", min_requests=400), str(tmp_path / "sums")
    expected = sorted(rate_table(frame(spark, events), own).collect(), key=str)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = daily_rate_table(spark, lambda days: frame(spark, events), store, own)
        assert sorted(found.collect(), key=str) == expected
        assert sorted(daily_rate_table(spark, None, store, own).collect(), key=str) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_failing_run_leaves_whole_days_or_none(spark, tmp_path, monkeypatch):
    own, store = settings("basic"), str(tmp_path / "sums")
    df = frame(spark, [event(at=days_ago(n)) for n in range(1, 6)])
    placed, real = [], rollups.replace_folder

    def fails_at_the_third(spark, fs, source, target):
        placed.append(target)
        if len(placed) == 3:
            raise OSError("gone")
        real(spark, fs, source, target)

    monkeypatch.setattr(rollups, "replace_folder", fails_at_the_third)
    with pytest.raises(OSError, match="gone"):
        refresh_rollup(spark, lambda days: df, store, own)
    monkeypatch.undo()
    assert missing_days(spark, store, own) == [date(2026, 1, n) for n in (3, 4, 5)]
    with pytest.raises(IncompleteRollup, match="2026-01-03, 2026-01-04, 2026-01-05"):
        rollup_rows(spark, store, own)
    assert [f.name for f in Path(store).iterdir()] == [Path(rollup_root(store, own)).name]
    same(daily_rate_table(spark, lambda days: df, store, own), rate_table(df, own))


def test_variants_keep_apart_stores(spark, tmp_path):
    store = str(tmp_path / "sums")
    df = frame(spark, random_events(2, collide=False))
    for variant in VARIANTS:
        own = settings(variant, min_requests=400)
        same(daily_rate_table(spark, lambda days: df, store, own), rate_table(df, own))
    with pytest.raises(ValueError, match="bids is missing"):
        refresh_rollup(spark, lambda days: df.drop("bids"), str(tmp_path / "other"), settings("basic"))


def test_a_catalog_table_is_asked_for_the_newest_day(spark, tmp_path):
    events = [event(at=days_ago(n, 3600), top=600) for n in range(10)]
    by_day = frame(spark, events).withColumn("day", F.to_date("record_date"))
    by_day.write.partitionBy("day").mode("overwrite").saveAsTable("daily_events")
    try:
        read = partial(table_day_events, spark, "daily_events", day_column="day")
        assert read([date(2026, 1, 5)]).select("record_date").distinct().count() == 1
        own = settings("basic")
        same(daily_rate_table(spark, read, str(tmp_path / "sums"), own), rate_table(frame(spark, events), own))
    finally:
        spark.sql("DROP TABLE daily_events")


def test_the_newest_day_is_scanned_once(spark, tmp_path, monkeypatch):
    """Of everything a second run does, one write reads the event files."""
    path, store = str(tmp_path / "raw"), str(tmp_path / "sums")
    read = stored(spark, path, [event(host="x", at=days_ago(n)) for n in range(8)])
    own = settings("basic")
    refresh_rollup(spark, read, store, run_of(own, -1))
    asked = []
    monkeypatch.setattr(daily, "add_days", lambda df, *a: asked.append(df) or rollups.add_days(df, *a))
    daily_rate_table(spark, read, store, own)
    (events,) = asked
    assert {f.split("day=")[1][:10] for f in events.inputFiles()} == {"2026-01-05"}


def test_command_line_with_a_store(spark, tmp_path):
    path, store = str(tmp_path / "events"), str(tmp_path / "sums")
    stored(spark, path, [event(at=days_ago(n, 3600), top=600) for n in range(10)])
    arguments = ["--events", path, "--out", str(tmp_path), "--day-column", "day", "--rollup", store]
    main([*arguments, "--as-of", "2026-01-05"])
    spoil(path, date(2026, 1, 5))
    written = json.loads(Path(main([*arguments, "--as-of", AS_OF.isoformat()])).read_text())
    assert written == {"b1": {"EU": {"FR": {"default": 1.0, "null": 0.05}}}}
    with pytest.raises(Exception):
        main([*arguments, "--as-of", AS_OF.isoformat(), "--again", "2026-01-04"])
