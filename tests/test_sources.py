"""Settings, reading, schema checks, staging and the command line."""

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from events import days_ago, event, frame, settings
from lotwise.__main__ import main
from lotwise.operators.counters import long_window
from lotwise.operators.document import InvalidRates
from lotwise.plans.publish import publish
from lotwise.plans.rate_table import rate_table
from lotwise.settings import Settings, basic, refined, utc_today
from lotwise.sources.events import check_columns, read_events, table_events
from lotwise.sources.staging import stage, staging_root


def test_windows_of_the_presets():
    one, two = basic(as_of=date(2026, 1, 6)), refined(as_of=date(2026, 1, 6))
    assert one.day_start.isoformat() == two.day_start.isoformat() == "2026-01-05T00:00:00+00:00"
    assert one.long_start.date() == date(2026, 1, 1)
    assert two.long_start.date() == date(2025, 12, 31)
    assert basic().as_of == utc_today()


@pytest.mark.parametrize(
    "wrong",
    [
        {"lookback_days": 0},
        {"lookback_days": 9},
        {"bands": ((5.0, 0.2), (50.0, 1.0))},
        {"volume": "opportunities"},
    ],
)
def test_wrong_settings(wrong):
    with pytest.raises(ValueError):
        Settings(**wrong)


def test_missing_and_mistyped_columns_are_named(spark):
    df = frame(spark, [event()])
    check_columns(df.drop("bid_opportunities", "estimated_adjusted_revenue"), settings("basic"))
    with pytest.raises(ValueError, match="bid_opportunities is missing"):
        check_columns(df.drop("bid_opportunities"), settings("refined"))
    with pytest.raises(ValueError, match="bids is double, needs bigint"):
        check_columns(df.withColumn("bids", F.col("bids").cast("double")), settings("basic"))
    with pytest.raises(ValueError, match="record_date is date"):
        dates = df.withColumn("record_date", F.col("record_date").cast("date"))
        rate_table(dates, settings("basic"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def write_by_day(spark, path):
    events = [event(at=days_ago(n, 3600), top=600) for n in range(10)] + [event(bidder="b2")]
    df = frame(spark, events)
    df.withColumn("day", F.to_date("record_date")).write.partitionBy("day").parquet(path)
    return df


def test_only_folders_of_the_window_are_read(spark, tmp_path):
    path = str(tmp_path / "events")
    everything = write_by_day(spark, path)
    own = settings("basic")
    keys = ["bidder_id", "record_date"]
    expected = sorted(long_window(everything, own).select(keys).collect())
    assert sorted(read_events(spark, path, own).select(keys).collect()) == expected
    # Beside the window: a stray folder, and a day whose file cannot be read.
    stray = tmp_path / "events" / "notes"
    stray.mkdir()
    (stray / "readme.parquet").write_text("no table")
    broken = tmp_path / "events" / "day=2019-05-05"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("no table")
    pruned = read_events(spark, path, own, day_column="day")
    assert "day" not in pruned.columns
    assert {f.split("day=")[1][:10] for f in pruned.inputFiles()} == {
        f"2026-01-0{n}" for n in range(1, 6)
    }
    assert sorted(pruned.select(keys).collect()) == expected
    late = basic(as_of=date(2020, 1, 1))
    assert read_events(spark, path, late, day_column="day").collect() == []


def test_a_catalog_table_is_read_by_its_partitions(spark):
    own = settings("basic")
    events = [event(at=days_ago(n, 3600), top=600) for n in range(10)]
    df = frame(spark, events)
    table = df.withColumn("day", F.to_date("record_date")).write.partitionBy("day")
    table.mode("overwrite").saveAsTable("auction_events")
    try:
        found = table_events(spark, "auction_events", own, day_column="day")
        assert "PartitionFilters: [isnotnull(day" in plan_of(found)
        expected = sorted(long_window(df, own).select("record_date").collect())
        assert sorted(found.select("record_date").collect()) == expected
    finally:
        spark.sql("DROP TABLE auction_events")


def test_tables_staged_by_a_run_are_freed_after_it_and_kept_if_it_fails(spark, tmp_path):
    root = f"{staging_root(spark)}/{spark.sparkContext.applicationId}"

    def staged():
        folder = Path(root.removeprefix("file://"))
        return set(folder.iterdir()) if folder.exists() else set()

    before = staged()
    df = frame(spark, [event(top=600), event(bidder="b2", top=700)])
    publish(df, settings("basic"), str(tmp_path))
    assert staged() == before
    with pytest.raises(InvalidRates):
        publish(frame(spark, [event(bidder="", top=600)]), settings("basic"), str(tmp_path))
    assert len(staged()) > len(before)


def test_staged_tables_go_to_the_folder_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert staging_root(spark) == root
    df = frame(spark, [event(), event(bidder="b2")])
    staged = stage(df, "copy")
    assert all(root in file for file in staged.inputFiles())
    assert staged.schema == df.schema
    assert sorted(staged.collect()) == sorted(df.collect())


def test_command_line(spark, tmp_path):
    events = str(tmp_path / "events")
    write_by_day(spark, events)
    arguments = ["--events", events, "--out", str(tmp_path), "--as-of", "2026-01-06"]
    arguments += ["--day-column", "day", "--variant", "basic", "--rates", str(tmp_path / "flat")]
    path = main([*arguments, "--request", '{"filename": "r.json", "override": {"x": 1}}'])
    assert path == str(tmp_path / "r.json")
    assert json.loads((tmp_path / "r.json").read_text()) == {
        "b1": {"EU": {"FR": {"default": 1.0, "null": 0.05}}},
        "b2": {"EU": {"FR": {"default": 0.05}}},
        "x": 1,
    }
    assert spark.read.parquet(str(tmp_path / "flat")).count() == 3


def test_command_line_takes_the_parameters_of_the_script(spark, tmp_path):
    events = str(tmp_path / "events")
    write_by_day(spark, events)
    arguments = ["--events", events, "--out", str(tmp_path), "--as-of", "2026-01-06"]
    arguments += ["--variant", "refined", "--extended-days", "3", "--default-rate", "0.1"]
    path = main([*arguments, "--bands", "60=0.9,10=0.3", "--min-rpr", "0.5", "--files", "2"])
    text = "".join(f.read_text() for f in sorted(Path(path).glob("part-*")))
    assert json.loads(text)["b2"] == {"EU": {"FR": {"default": 0.1}}}
