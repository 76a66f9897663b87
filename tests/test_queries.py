"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as spec
from compare import canonical, connect, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.01"
ORACLES = spec.rate_oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(spec.rate_queries()))
def test_query_equals_sql(spark, duck, name):
    df = spec.queries()[name](spark, SF_DIR)
    columns, rows = canonical(*spark_rows(df))
    assert rows
    assert (columns, rows) == canonical(*duck_rows(duck, ORACLES[name]))


def test_every_query_has_sql():
    assert set(ORACLES) == set(spec.rate_queries())


def test_entry_runs(spark):
    df = spec.entry(spark)
    assert df.columns == ["bidder", "continent", "country", "host", "filter"]
    assert df.count() == 96
