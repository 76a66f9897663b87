"""Random small events, full of NULLs, sentinels, edges and key collisions, against the SQL."""

import random

import duckdb
import pytest

from compare import canonical, duck_rows, spark_rows
from events import days_ago, event, frame, load_duck, oracle, settings
from lotwise.plans.rate_table import rate_table
from lotwise_checks.comparison import rate_table_by_scans

# Requests are hundreds and few, so no ratio ends in a rounding tie a double cannot hold.
AGES = [(0, 0), (1, 0), (1, 0), (1, 0), (1, 86_399), (2, 0), (4, 0), (5, 0), (6, 0), (7, 86_399)]


def random_events(seed, collide, size=260):
    pick = random.Random(seed)
    countries = ["FR", "DE", "RU", "nan", "", None] + (["default"] if collide else [])
    hosts = ["x.com", "y.com", "", None] + (["default"] if collide else [])
    return [
        event(
            bidder=pick.choice(["b1", "b2", "b3", "unrulyfsx", None]),
            continent=pick.choice(["EU", "EU", "AS", "nan", None]),
            country=pick.choice(countries),
            host=pick.choice(hosts),
            requests=pick.choice([100, 200, 300, None]),
            offers=pick.choice([0, 100, 200, 300]),
            top=pick.choice([0, 1, 5, 20, 40, 90, None]),
            bids=pick.choice([0, 0, 5, 20, 60, 120, None]),
            revenue=pick.choice([0, 0, "0.0001", "0.5", None]),
            error=pick.choice([None, None, None, "500", "404"]),
            at=days_ago(*pick.choice(AGES)),
        )
        for _ in range(size)
    ]


@pytest.mark.parametrize("variant", ["basic", "refined"])
@pytest.mark.parametrize("collide", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_rate_table(spark, seed, collide, variant):
    events = random_events(seed, collide)
    own = settings(variant, min_requests=400)
    con = duckdb.connect()
    load_duck(con, events)
    expected = canonical(*duck_rows(con, oracle(own).select("rates")))
    df = frame(spark, events)
    columns, rows = spark_rows(rate_table(df, own))
    assert canonical(columns, rows) == expected
    assert canonical(*spark_rows(rate_table_by_scans(df, own))) == expected
    allowed = {0.0, 0.05, 1.0} | ({0.25, 0.5, 0.75} if own.refined else set())
    assert rows and {row[4] for row in rows} <= allowed
    if not collide:
        keys = [row[:4] for row in rows]
        assert len(set(keys)) == len(keys)
        parents = {row[:3]: row[4] for row in rows if row[3] == "default"}
        assert all(parents[row[:3]] != row[4] for row in rows if row[3] != "default")
        assert all(row[4] == 0 for row in rows if row[2] == "RU")
