"""Event files pruned by an index of the times they cover."""

import os
from datetime import date
from pathlib import Path

import pytest

from events import days_ago, event, frame, settings
from lotwise.__main__ import main
from lotwise.operators.counters import long_window
from lotwise.settings import basic
from lotwise.sources.file_index import overlapping_files, read_indexed_events, refresh_index

KEYS = ["bidder_id", "record_date"]


def write_days(spark, path, ages, mode="errorifexists", **changes):
    """One file for each day before the run's day."""
    for age in ages:
        df = frame(spark, [event(at=days_ago(age, 3600), **changes), event(bidder="b2", at=days_ago(age, 80_000))])
        df.coalesce(1).write.mode(mode).parquet(f"{path}/batch {age}")


def data_files(path):
    return sorted(Path(path).rglob("part-*.parquet"))


def everything(spark, path):
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def same_rows(spark, path, index, own):
    found = read_indexed_events(spark, path, index, own).select(KEYS)
    assert sorted(found.collect()) == sorted(long_window(everything(spark, path), own).select(KEYS).collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "events")
    write_days(spark, path, range(12))
    return path, str(tmp_path / "index")


def test_files_outside_the_window_are_not_opened(spark, table):
    path, index = table
    own = settings("basic")
    same_rows(spark, path, index, own)
    assert overlapping_files(spark, path, index, own).count() == 5
    expected = sorted(read_indexed_events(spark, path, index, own).select(KEYS).collect())
    kept = {f"batch {n}" for n in range(1, 6)}
    for file in data_files(path):
        if file.parent.name not in kept:
            changed = file.stat()
            file.write_bytes(b"x" * changed.st_size)
            os.utime(file, ns=(changed.st_atime_ns, changed.st_mtime_ns))
    df = read_indexed_events(spark, path, index, own)
    assert {Path(f).parent.name.replace("%20", " ") for f in df.inputFiles()} == kept
    assert sorted(df.select(KEYS).collect()) == expected


def test_only_new_and_changed_files_are_read_for_the_index(spark, table):
    path, index = table
    own = settings("refined")
    assert refresh_index(spark, path, index) == 12
    assert refresh_index(spark, path, index) == 0
    write_days(spark, path, [12, 13])
    assert refresh_index(spark, path, index) == 2
    # The file of the second day is replaced by one of another time, that of the third goes.
    for file in data_files(f"{path}/batch 2"):
        file.unlink()
    frame(spark, [event(bidder="new", at=days_ago(40)), event(bidder="b9", at=days_ago(1))]).coalesce(1).write.mode(
        "append"
    ).parquet(f"{path}/batch 2")
    for file in data_files(f"{path}/batch 3"):
        file.unlink()
    assert refresh_index(spark, path, index) == 1
    same_rows(spark, path, index, own)
    assert overlapping_files(spark, path, index, own).count() == 5


def test_empty_files_missing_times_and_windows_without_files(spark, tmp_path):
    path, index = str(tmp_path / "events"), str(tmp_path / "index")
    own = settings("basic")
    frame(spark, []).coalesce(1).write.parquet(f"{path}/none")
    rows = [event(at=days_ago(2)), (*event()[:5], None, *event()[6:])]
    frame(spark, rows).coalesce(1).write.parquet(f"{path}/some")
    assert refresh_index(spark, path, index) == len(data_files(path))
    assert refresh_index(spark, path, index) == 0
    same_rows(spark, path, index, own)
    assert read_indexed_events(spark, path, index, basic(as_of=date(2020, 1, 1))).collect() == []


def test_command_line_with_an_index(spark, table, tmp_path):
    path, index = table
    arguments = ["--events", path, "--out", str(tmp_path), "--as-of", "2026-01-06", "--index", index]
    assert Path(main(arguments)).read_text() == '{"b1":{"EU":{"FR":{"default":0.05}}}\n,"b2":{"EU":{"FR":{"default":0.05}}}}\n'
    with pytest.raises(SystemExit):
        main([*arguments, "--day-column", "day"])
