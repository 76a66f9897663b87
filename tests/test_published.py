"""Documents read back from the files they were published as."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lotwise.operators.document import (
    distinct_leaves,
    document_lines,
    fold_rates,
    override_rows,
    part_of,
    parts_needed,
    unfold_rates,
)
from lotwise.plans.publish import publish_rates
from lotwise.sources.documents import completed_lines, read_document, text_lines
from lotwise.sources.events import RATE_SCHEMA
from lotwise.sources.requests import Request
from lotwise.sources.sinks import write_document

ODD = ["plain", 'a"b', "back\\slash", '":{', "}{", "new\nline", "ünï", "", " ", "default", "null", "\\", 'q\\":{"x']
OVERRIDES = [
    None,
    '{"z": 1}',
    '{"": {"a{b": {"c}": {"d\\"": 0.5}}}, "plain": 7, "b": {"EU": {"default": 0.25, "RU": {"x": 0}}}}',
]


def random_rates(seed, size=300):
    """Valid rows with one rate a key."""
    pick = random.Random(seed)
    names = [n for n in ODD if n]
    rows = {}
    for _ in range(size):
        country = pick.choice([*names, "K1", "K2"])
        host = "default" if country == "default" else pick.choice([*ODD, f"h{pick.randrange(30)}"])
        rows[pick.choice([*names, "b"]), pick.choice([*names, "EU"]), country, host] = pick.choice([0.0, 0.05, 1.0])
    return [(*key, rate) for key, rate in rows.items()]


def flattened(document):
    """(bidder, continent, country, host) to rate of a document as Python reads it."""
    found = {}
    for bidder, continents in document.items():
        if not isinstance(continents, dict):
            found[bidder, None, None, None] = continents
            continue
        for continent, countries in continents.items():
            for country, hosts in countries.items():
                if not isinstance(hosts, dict):
                    found[bidder, continent, country, "default"] = hosts
                    continue
                for host, rate in hosts.items():
                    found[bidder, continent, country, host] = rate
    return found


def leaves_of(df):
    rows = df.collect()
    found = {tuple(r[:4]): r[4] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few lines, so that most blocks begin within a country."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("override", OVERRIDES)
@pytest.mark.parametrize("files", [None, 1, 5])
def test_what_is_published_is_read_back(spark, tmp_path, files, override, small_blocks):
    rows = random_rates(len(override or ""))
    rates = spark.createDataFrame(rows, RATE_SCHEMA)
    path = publish_rates(rates, str(tmp_path), Request(override), files=files)
    parts = [tmp_path / "traffic-rates.json"] if files is None else sorted((tmp_path / "traffic-rates.json").glob("part-*"))
    whole = json.loads("".join(p.read_text() for p in parts))
    wanted = flattened(whole)
    lines = text_lines(spark, path)
    assert lines.select("file", "block").distinct().count() > 3 * (files or 1)
    assert leaves_of(unfold_rates(read_document(spark, path))) == wanted
    if override is None:
        assert wanted == {tuple(r[:4]): r[4] for r in rows}


def test_every_line_is_completed_by_the_keys_above_it(spark, tmp_path, small_blocks):
    rates = spark.createDataFrame(random_rates(1), RATE_SCHEMA)
    lines = document_lines(distinct_leaves(rates))
    write_document(lines, str(tmp_path / "d.json"), 3)
    texts = [r[0] for r in completed_lines(text_lines(spark, str(tmp_path / "d.json"))).collect()]
    assert len(texts) == rates.count()
    for text in texts:
        value, depth = json.loads(text), 0
        while isinstance(value, dict):
            assert len(value) == 1
            (value,), depth = value.values(), depth + 1
        assert depth in (3, 4)


@pytest.mark.parametrize("rows", [[("b", "EU", "default", "default", 0.5)], [("b", "EU", "FR", "h", 0.5)]])
def test_documents_of_one_line(spark, tmp_path, rows):
    path = publish_rates(spark.createDataFrame(rows, RATE_SCHEMA), str(tmp_path))
    assert leaves_of(unfold_rates(read_document(spark, path))) == {tuple(rows[0][:4]): 0.5}


def test_an_override_of_everything(spark, tmp_path):
    rates = spark.createDataFrame([("b", "EU", "FR", "h", 0.5)], RATE_SCHEMA)
    overrides = override_rows(spark, '{"b": {"AS": {"default": 1}}}')
    path = str(tmp_path / "d.json")
    write_document(document_lines(distinct_leaves(rates), overrides), path)
    assert leaves_of(unfold_rates(read_document(spark, path))) == {("b", "AS", "default", "default"): 1.0}


def many(spark, hot=3000, others=30):
    """One bidder with nearly all leaves, in one country."""
    rows = [("hot", "EU", "FR", f"h{i}", i / hot) for i in range(hot)]
    rows += [(f"b{i % 7}", "EU", f"K{i}", f"h{i}", 0.5) for i in range(others)]
    return spark.createDataFrame(rows, RATE_SCHEMA), {tuple(r[:4]): r[4] for r in rows}


@pytest.mark.parametrize("most", [1, 40, 1000, 100_000])
def test_no_part_has_more_leaves_than_asked(spark, most):
    df, rows = many(spark, hot=300 if most == 1 else 3000)
    folded = fold_rates(df, most=most)
    leaves = unfold_rates(folded.withColumn("bidder", F.concat("bidder", F.lit("/"), "part")))
    sizes = leaves.groupBy("bidder").count().agg(F.max("count")).first()[0]
    assert sizes <= most
    assert leaves_of(unfold_rates(folded)) == rows
    assert folded.count() == (1 + 7 if most == 100_000 else folded.select("bidder", "part").distinct().count())


def test_parts_needed_grow_with_the_largest_bidder_only(spark):
    df, _ = many(spark)
    assert parts_needed(df, 100_000) == 1
    assert 30 <= parts_needed(df, 100) <= 200
    assert parts_needed(df.filter("bidder <> 'hot'"), 100) == 1
    assert parts_needed(df.limit(0), 1) == 1


def test_parts_are_the_same_for_equal_keys(spark):
    df, _ = many(spark)
    other = df.withColumn("bidder", F.lit("x")).select("*", part_of(9).alias("p"))
    met = df.select("*", part_of(9).alias("q")).join(other, ["continent", "country", "host"])
    assert met.filter("p <> q").count() == 0
    assert met.select("p").distinct().count() == 9
