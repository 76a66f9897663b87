"""Folding, validation, overrides and the published text."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lotwise.operators.document import (
    InvalidRates,
    check_rates,
    distinct_leaves,
    document_lines,
    fold_rates,
    merge_overrides,
    override_rows,
    rate_violations,
    unfold_rates,
)
from lotwise.plans.publish import publish_rates
from lotwise.sources.events import RATE_SCHEMA
from lotwise.sources.requests import Request, parse_request
from lotwise.sources import sinks
from lotwise.sources.sinks import write_document

FR, DEFAULT = "FR", "default"


def rates(spark, *rows):
    return spark.createDataFrame([(*r[:4], r[4]) for r in rows], RATE_SCHEMA)


def folded(documents):
    """Bidder documents as one dict; parts of a bidder are merged level by level."""
    merged = {}
    for row in documents.select("bidder", F.to_json("document").alias("text")).collect():
        value = json.loads(row.text)
        if row.bidder not in merged or not isinstance(value, dict):
            merged[row.bidder] = value
            continue
        for continent, countries in value.items():
            own = merged[row.bidder].setdefault(continent, {})
            for country, hosts in countries.items():
                if isinstance(hosts, dict):
                    own.setdefault(country, {}).update(hosts)
                else:
                    own[country] = hosts
    return merged


def published(lines):
    ordered = lines.orderBy("bidder", "continent", "country", "host").collect()
    return json.loads("\n".join(r.line for r in ordered))


# One case per rule of the document: rows in any order, the object they fold into.
ROWS = {
    "a continent's default beside an object": (
        [("hammer", "OC", DEFAULT, DEFAULT, 0.35), ("hammer", "OC", "NZ", "kiwi.example", 0.6)],
        {"hammer": {"OC": {"NZ": {"kiwi.example": 0.6}, DEFAULT: 0.35}}},
    ),
    "nothing but a continent's default": (
        [("hammer", "OC", DEFAULT, DEFAULT, 0.15)],
        {"hammer": {"OC": {DEFAULT: 0.15}}},
    ),
    "a country's default is a member of its object": (
        [("hammer", "NA", "MX", DEFAULT, 0.45)],
        {"hammer": {"NA": {"MX": {DEFAULT: 0.45}}}},
    ),
    "hosts around their country's default": (
        [
            ("hammer", "NA", "MX", "zapote.example", 0.0),
            ("hammer", "NA", "MX", DEFAULT, 0.7),
            ("hammer", "NA", "MX", "agave.example", 0.3),
        ],
        {"hammer": {"NA": {"MX": {DEFAULT: 0.7, "agave.example": 0.3, "zapote.example": 0.0}}}},
    ),
    "countries that sort before and after the default": (
        [
            ("hammer", "EU", "dk", "fjord.example", 0.55),
            ("hammer", "EU", "zz", "last.example", 0.65),
            ("hammer", "EU", DEFAULT, DEFAULT, 0.4),
            ("hammer", "EU", "PL", DEFAULT, 0.9),
        ],
        {
            "hammer": {
                "EU": {
                    "PL": {DEFAULT: 0.9},
                    "dk": {"fjord.example": 0.55},
                    DEFAULT: 0.4,
                    "zz": {"last.example": 0.65},
                }
            }
        },
    ),
    "bidders share neither places nor shapes": (
        [
            ("anvil", "AS", "JP", DEFAULT, 0.05),
            ("hammer", "AS", DEFAULT, DEFAULT, 0.85),
            ("tongs", "EU", "PL", "wisla.example", 1.0),
            ("tongs", "AS", "JP", "fuji.example", 0.25),
            ("tongs", "EU", DEFAULT, DEFAULT, 0.0),
        ],
        {
            "anvil": {"AS": {"JP": {DEFAULT: 0.05}}},
            "hammer": {"AS": {DEFAULT: 0.85}},
            "tongs": {
                "AS": {"JP": {"fuji.example": 0.25}},
                "EU": {"PL": {"wisla.example": 1.0}, DEFAULT: 0.0},
            },
        },
    ),
    "empty, missing and awkward hosts": (
        [
            ("a", "AF", "ZA", None, 0.5),
            ("a", "AF", "ZA", "", 0.0),
            ("a", "AF", "ZA", 'q"\\\n', 1.0),
            ('b"{', "É", "ZA", "ü.com", 1.0),
        ],
        {
            "a": {"AF": {"ZA": {"null": 0.5, "": 0.0, 'q"\\\n': 1.0}}},
            'b"{': {"É": {"ZA": {"ü.com": 1.0}}},
        },
    ),
}


@pytest.mark.parametrize("case", sorted(ROWS))
def test_fold_and_published_text(spark, case):
    rows, expected = ROWS[case]
    for order in (rows, rows[::-1]):
        df = check_rates(rates(spark, *order))
        documents = fold_rates(df)
        assert folded(documents) == expected
        assert {r.part for r in documents.collect()} == {0}
        assert published(document_lines(distinct_leaves(df))) == expected


def test_integer_rates_become_doubles(spark):
    df = spark.createDataFrame(
        [("a", "AF", FR, "w.com", 1)],
        "bidder string, continent string, country string, host string, filter int",
    )
    assert fold_rates(df).select(F.to_json("document")).first()[0] == '{"AF":{"FR":{"w.com":1.0}}}'


def test_last_duplicate_wins_by_an_order_column_else_the_highest(spark, tmp_path):
    df = rates(spark, *[("a", "AF", FR, "w.com", rate) for rate in (0.5, 1.0, 0.2)])
    sequenced = df.withColumn("seq", F.when(F.col("filter") == 0.2, 9).otherwise(1))
    assert distinct_leaves(sequenced, "seq").first()["filter"] == 0.2
    assert folded(fold_rates(sequenced, "seq")) == {"a": {"AF": {FR: {"w.com": 0.2}}}}
    assert folded(fold_rates(df)) == {"a": {"AF": {FR: {"w.com": 1.0}}}}
    path = publish_rates(sequenced, str(tmp_path), order_by="seq")
    assert json.loads(Path(path).read_text()) == {"a": {"AF": {FR: {"w.com": 0.2}}}}


def big_rates(spark, hot=3000):
    """One bidder holds most leaves; every shape of key occurs."""
    pick = random.Random(5)
    rows = {("hot", "EU", FR, f"h{i}.com"): pick.choice([0.0, 0.05, 1.0]) for i in range(hot)}
    for i in range(400):
        key = (f"b{i % 7}", pick.choice(["EU", "AS"]), pick.choice([FR, "DE", DEFAULT]))
        host = DEFAULT if key[2] == DEFAULT else pick.choice([DEFAULT, "x.com", "y.com"])
        rows[(*key, host)] = pick.choice([0.25, 0.5])
    rows[("hot", "EU", DEFAULT, DEFAULT)] = 0.75
    return rates(spark, *[(*key, rate) for key, rate in rows.items()]), rows


def nested(rows):
    document = {}
    for (bidder, continent, country, host), rate in rows.items():
        places = document.setdefault(bidder, {}).setdefault(continent, {})
        if country == DEFAULT:
            places[DEFAULT] = rate
        else:
            places.setdefault(country, {})[host] = rate
    return document


def test_parts_are_alike_for_every_bidder_and_merge_to_the_whole(spark):
    df, rows = big_rates(spark)
    documents = fold_rates(df, parts=7)
    counts = documents.groupBy("bidder").agg(F.count("*").alias("n"))
    parts = {r.bidder: r.n for r in counts.collect()}
    assert parts["hot"] == 7 and max(parts.values()) == 7
    assert folded(documents) == nested(rows)
    leaves = unfold_rates(documents)
    assert {tuple(r[:4]): r[4] for r in leaves.collect()} == rows
    assert leaves.count() == len(rows)


def test_one_part_whatever_the_number_of_leaves(spark):
    df = rates(spark, *[("a", "AF", FR, f"h{i}.com", 1.0) for i in range(3000)])
    assert [r.part for r in fold_rates(df).collect()] == [0]


@pytest.mark.parametrize("files", [None, 1, 4])
def test_the_caller_chooses_the_layout(spark, tmp_path, files):
    df, rows = big_rates(spark)
    path = tmp_path / "big.json"
    for _ in range(2):
        write_document(document_lines(distinct_leaves(df)), str(path), files)
    written = [path] if files is None else sorted(path.glob("part-*"))
    assert len(written) == (files or 1)
    assert json.loads("".join(f.read_text() for f in written)) == nested(rows)
    assert {f.name for f in tmp_path.iterdir() if not f.name.endswith(".crc")} == {"big.json"}


def lines_of(spark, rate=1.0):
    return document_lines(distinct_leaves(rates(spark, ("a", "AF", FR, DEFAULT, rate))))


def test_other_folders_and_files_are_never_replaced(spark, tmp_path):
    own = tmp_path / "mine"
    own.mkdir()
    (own / "keep.txt").write_text("keep")
    plain = tmp_path / "plain.json"
    plain.write_text("{}")
    for path, files in ((own, None), (own, 2), (plain, 2)):
        with pytest.raises(FileExistsError):
            write_document(lines_of(spark), str(path), files)
    assert (own / "keep.txt").read_text() == "keep" and plain.read_text() == "{}"
    assert {f.name for f in tmp_path.iterdir() if not f.name.startswith(".")} == {"mine", "plain.json"}


@pytest.mark.parametrize("files", [None, 2])
def test_a_failing_rename_leaves_the_earlier_document(spark, tmp_path, files, monkeypatch):
    path = tmp_path / "r.json"
    write_document(lines_of(spark), str(path), files)
    read = lambda: path.read_text() if files is None else "".join(f.read_text() for f in sorted(path.glob("part-*")))
    before = read()

    def gone(spark, fs, source, target):
        fs.delete(source, True)
        return real(spark, fs, source, target)

    name = "_replace_file" if files is None else "replace_folder"
    real = getattr(sinks, name)
    monkeypatch.setattr(sinks, name, gone)
    with pytest.raises(Exception):
        write_document(lines_of(spark, 0.5), str(path), files)
    assert read() == before
    assert {f.name for f in tmp_path.iterdir() if not f.name.endswith(".crc")} == {"r.json"}


def test_valid_rates_pass(spark):
    df = rates(spark, ("a", "AF", FR, None, 0.0), ("a", "AF", FR, "", float("nan")))
    assert check_rates(df) is df


@pytest.mark.parametrize(
    ("row", "rule"),
    [
        (("", "AF", FR, "x", 1.0), "empty_bidder"),
        ((None, "AF", FR, "x", 1.0), "empty_bidder"),
        (("a", "", FR, "x", 1.0), "empty_continent"),
        (("a", "AF", "", "x", 1.0), "empty_country"),
        (("a", "AF", None, "x", 1.0), "empty_country"),
        (("a", "AF", FR, "x", None), "missing_rate"),
        (("a", "AF", FR, "x", -0.1), "negative_rate"),
        (("a", "AF", DEFAULT, "x", 1.0), "default_country_with_other_host"),
        (("a", "AF", DEFAULT, "", 1.0), "default_country_with_other_host"),
        (("a", "AF", DEFAULT, None, 1.0), "default_country_with_other_host"),
    ],
)
def test_invalid_rows(spark, row, rule):
    df = rates(spark, ("a", "AF", FR, DEFAULT, 1.0), row)
    broken = rate_violations(df).filter("violations > 0").collect()
    assert [(r.rule, r.violations) for r in broken] == [(rule, 1)]
    with pytest.raises(InvalidRates, match=rule):
        check_rates(df)
    text = "non default host" if rule.startswith("default") else rule
    with pytest.raises(Exception, match=text):
        fold_rates(df).collect()


def test_default_country_error_names_the_host(spark):
    df = rates(spark, ("tongs", "AS", DEFAULT, "fuji.example", 0.25))
    wanted = "default country and non default host isn't allowed: fuji.example"
    with pytest.raises(InvalidRates, match=wanted):
        check_rates(df)


def test_empty_result_is_an_error(spark):
    for step in (check_rates, fold_rates):
        with pytest.raises(InvalidRates, match="empty query result list"):
            step(rates(spark))


OVERRIDE = {"tongs": {"EU": {DEFAULT: 0.5}}, "site.example": 1.0, "z": None, "0": {}, "s": "text"}


def test_overrides_replace_whole_bidders_and_add_keys(spark):
    rows, expected = ROWS["bidders share neither places nor shapes"]
    df = rates(spark, *rows)
    overrides = override_rows(spark, json.dumps(OVERRIDE))
    assert folded(merge_overrides(fold_rates(df), overrides)) == expected | OVERRIDE
    assert published(document_lines(distinct_leaves(df), overrides)) == expected | OVERRIDE


def test_overrides_may_replace_every_bidder(spark):
    df = rates(spark, ("a", "AF", FR, DEFAULT, 1.0))
    overrides = override_rows(spark, '{"a": 1}')
    assert published(document_lines(distinct_leaves(df), overrides)) == {"a": 1}


def test_publish_writes_one_complete_document(spark, tmp_path):
    rows, expected = ROWS["bidders share neither places nor shapes"]
    request = Request(override='{"anvil": 0.5}', filename="qa.json")
    flat = tmp_path / "flat"
    path = publish_rates(rates(spark, *rows), str(tmp_path), request, str(flat))
    assert path == str(tmp_path / "qa.json")
    assert json.loads((tmp_path / "qa.json").read_text()) == expected | {"anvil": 0.5}
    back = spark.read.parquet(str(flat)).collect()
    assert [tuple(r) for r in back] == sorted(rows)


def test_publish_overwrites_the_document(spark, tmp_path):
    for rate in (1.0, 0.5):
        publish_rates(rates(spark, ("a", "AF", FR, DEFAULT, rate)), str(tmp_path))
    document = tmp_path / "traffic-rates.json"
    assert json.loads(document.read_text()) == {"a": {"AF": {FR: {DEFAULT: 0.5}}}}
    assert [f for f in tmp_path.iterdir() if not f.name.startswith(".")] == [document]


def test_an_invalid_row_publishes_nothing(spark, tmp_path):
    df = rates(spark, ("a", "AF", FR, DEFAULT, 1.0), ("", "AF", FR, DEFAULT, 1.0))
    with pytest.raises(InvalidRates):
        publish_rates(df, str(tmp_path), rates_path=str(tmp_path / "flat"))
    assert list(tmp_path.iterdir()) == []


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, Request()),
        ("{}", Request()),
        ('{"override": null}', Request()),
        ('{"override": {}}', Request()),
        ('{"filename": "x.json", "minBidRate": "0.25"}', Request(filename="x.json")),
        ('{"override": {"site.example": 1.0}}', Request(override='{"site.example": 1.0}')),
    ],
)
def test_requests(text, expected):
    assert parse_request(text) == expected


@pytest.mark.parametrize(
    "name", ["", None, " ", ".", "..", "../x.json", "/x.json", "a/b.json", "a\\b", "x\n", ".hidden", "_x", 3]
)
def test_filenames_are_plain_names(spark, tmp_path, name):
    (tmp_path / "other.txt").write_text("keep")
    with pytest.raises(ValueError, match="plain name"):
        parse_request(json.dumps({"filename": name}))
    assert (tmp_path / "other.txt").read_text() == "keep"


@pytest.mark.parametrize("text", ["[]", '{"override": 3}', '{"override": ["a"]}'])
def test_requests_of_the_wrong_shape(text):
    with pytest.raises(ValueError):
        parse_request(text)
