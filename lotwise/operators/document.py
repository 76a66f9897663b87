"""Validation, folding into a nested document, and manual overrides.

The document is ``{bidder: {continent: {"default": rate, country: {host: rate}}}}``. Under a
continent the key ``default`` holds a number and every other key an object, which a map type
cannot express, so folded values are VARIANT.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.operators.counters import COUNTRY_KEYS, HOST_KEYS
from lotwise.settings import DEFAULT
from lotwise.sources.staging import stage

# Messages callers match on, and the key a missing host is published under.
EMPTY_RESULT_MESSAGE = "Failed to map results: empty query result list"
DEFAULT_HOST_MESSAGE = (
    "Invalid row format: default country and non default host isn't allowed: {0}"
)
NULL_HOST_KEY = "null"
# End of fixed values.

# Leaves that one folded document may hold, and how a leaf's key decides its part.
LEAVES_PER_PART = 100_000
PART_SEPARATOR, PART_DIGITS = "\x1f", 15

DEFAULT_COUNTRY_RULE = "default_country_with_other_host"
EMPTY_RULE = "empty_result"


class InvalidRates(ValueError):
    """The rate table breaks a rule; nothing may be published."""


def _row_rules() -> dict[str, Column]:
    def blank(name: str) -> Column:
        return F.col(name).isNull() | (F.col(name) == "")

    other_host = F.col("host").isNull() | (F.col("host") != DEFAULT)
    return {
        "empty_bidder": blank("bidder"),
        "empty_continent": blank("continent"),
        "empty_country": blank("country"),
        "missing_rate": F.col("filter").isNull(),
        # NaN is not below 0 in Spark, which orders it last.
        "negative_rate": F.col("filter") < 0,
        DEFAULT_COUNTRY_RULE: (F.col("country") == DEFAULT) & other_host,
    }


def rate_violations(rates: DataFrame) -> DataFrame:
    """One row per rule: how many rate rows break it, and the smallest such row as an example."""
    row = F.to_json(F.struct("bidder", "continent", "country", "host", "filter"))
    rules = _row_rules()
    found = [F.count_if(broken).alias(f"{rule}_n") for rule, broken in rules.items()]
    examples = [F.min(F.when(broken, row)).alias(f"{rule}_e") for rule, broken in rules.items()]
    totals = rates.agg(F.count("*").alias("total"), *found, *examples)

    def report(rule: str, violations: Column, example: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"),
            violations.cast("bigint").alias("violations"),
            example.cast("string").alias("example"),
        )

    reports = [report(rule, F.col(f"{rule}_n"), F.col(f"{rule}_e")) for rule in rules]
    reports.append(report(EMPTY_RULE, (F.col("total") == 0).cast("int"), F.lit(None)))
    return totals.select(F.inline(F.array(*reports)))


def check_rates(rates: DataFrame) -> DataFrame:
    """Raise ``InvalidRates`` unless every row is valid and there is one. Runs one aggregate."""
    broken = {r.rule: r for r in rate_violations(rates).filter("violations > 0").collect()}
    if EMPTY_RULE in broken:
        raise InvalidRates(EMPTY_RESULT_MESSAGE)
    messages = []
    for rule, found in broken.items():
        text = f"{rule}: {found.violations} rows, such as {found.example}"
        if rule == DEFAULT_COUNTRY_RULE:
            host = rates.filter(_row_rules()[rule]).agg(F.min("host")).first()[0]
            text = f"{DEFAULT_HOST_MESSAGE.format(host)} ({text})"
        messages.append(text)
    if messages:
        raise InvalidRates("; ".join(messages))
    return rates


def distinct_leaves(rates: DataFrame, order_by: str | None = None) -> DataFrame:
    """One rate per key. The last row by ``order_by`` wins; without it, the highest rate.

    Rows have no order of their own, and the highest rate is the same on every run.
    """
    rate = F.max_by("filter", order_by) if order_by else F.max("filter")
    host = F.coalesce(F.col("host"), F.lit(NULL_HOST_KEY))
    return (
        rates.select(*COUNTRY_KEYS, host.alias("host"), "filter", *([order_by] if order_by else []))
        .groupBy(*HOST_KEYS)
        .agg(rate.cast("double").alias("filter"))
    )


def _checked(rates: DataFrame) -> DataFrame:
    """``rates`` whose rows fail the query when they break a rule; needs no pass of its own."""
    bidder = F
    for rule, broken in _row_rules().items():
        message = F.lit(f"Invalid row format: {rule}")
        if rule == DEFAULT_COUNTRY_RULE:
            host = F.coalesce(F.col("host"), F.lit(NULL_HOST_KEY))
            message = F.concat(F.lit(DEFAULT_HOST_MESSAGE.format("")), host)
        bidder = bidder.when(broken, F.raise_error(message).cast("string"))
    return rates.withColumn("bidder", bidder.otherwise(F.col("bidder")))


def _as_object(key: str, value: str) -> Column:
    return F.to_variant_object(F.map_from_entries(F.collect_list(F.struct(key, value))))


def part_of(parts: int) -> Column:
    """The part of a leaf, by its key below the bidder; any SQL engine can work it out."""
    key = F.md5(F.concat_ws(PART_SEPARATOR, "continent", "country", "host"))
    number = F.conv(F.substring(key, 1, PART_DIGITS), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(parts)).cast("int")


def parts_needed(leaves: DataFrame, most: int) -> int:
    """The number of parts, the same for every bidder, for which none has more than ``most`` leaves.

    Every try counts the leaves of each part, combined map-side; the next is as many times larger
    as the largest part was too large, so that two or three do.
    """
    parts = 1
    while True:
        sizes = leaves.groupBy("bidder", part_of(parts)).agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.agg(F.max("n")).first()[0] or 0
        if largest <= most:
            return parts
        parts *= max(2, -(-largest // most))


def fold_rates(
    rates: DataFrame,
    order_by: str | None = None,
    parts: int | None = None,
    most: int = LEAVES_PER_PART,
) -> DataFrame:
    """Nested documents: (bidder, part, document).

    The rates of every bidder alike are spread over parts by their key, so that no group outgrows
    a task or the size limit of a VARIANT (128 MB): over ``parts`` of them, or over as few as it
    takes for none to have more than ``most`` leaves. The parts of a bidder have no leaf in common
    and are never put together; unfolding and overrides take them as they are, and the published
    text is made from leaves.

    Calling it runs jobs, as the distinct leaves are written once. After that one shuffle on bidder
    and part serves all three levels. An invalid row fails the call, and so does an empty table;
    ``check_rates`` also reports how many rows break which rule.
    """
    leaves = stage(distinct_leaves(_checked(rates), order_by), "leaves")
    if leaves.isEmpty():
        raise InvalidRates(EMPTY_RESULT_MESSAGE)
    placed = leaves.withColumn("part", part_of(parts or parts_needed(leaves, most)))
    countries = (
        placed.repartition("bidder", "part")
        .groupBy("bidder", "part", "continent", "country")
        .agg(_as_object("host", "filter").alias("hosts"), F.max("filter").alias("rate"))
        .select(
            "bidder",
            "part",
            "continent",
            "country",
            F.when(F.col("country") == DEFAULT, F.col("rate").cast("variant"))
            .otherwise(F.col("hosts"))
            .alias("value"),
        )
    )
    continents = countries.groupBy("bidder", "part", "continent").agg(
        _as_object("country", "value").alias("value")
    )
    return continents.groupBy("bidder", "part").agg(
        _as_object("continent", "value").alias("document")
    )


def _entries_of(documents: DataFrame, value: str, key: str, keep: Sequence[str]) -> DataFrame:
    """One row per member of an object; a value that is no object keeps its row, with no key."""
    spark = documents.sparkSession
    members = spark.tvf.variant_explode_outer(F.col(value).outer()).alias("member")
    return documents.alias("d").lateralJoin(members).select(
        *[F.col(f"d.{name}") for name in keep],
        F.col("member.key").alias(key),
        F.coalesce(F.col("member.value"), F.col(f"d.{value}")).alias(value),
    )


def unfold_rates(documents: DataFrame) -> DataFrame:
    """Documents back to one row per leaf. Levels an override skips are NULL; a leaf that is no
    number has a NULL rate."""
    flat, keep = documents, ["bidder"]
    for level in ("continent", "country", "host"):
        flat = _entries_of(flat, "document", level, keep)
        keep.append(level)
    plain = (F.col("country") == DEFAULT) & F.col("host").isNull()
    return flat.select(
        *COUNTRY_KEYS,
        F.when(plain, DEFAULT).otherwise(F.col("host")).alias("host"),
        F.try_variant_get("document", "$", "double").alias("filter"),
    )


def override_rows(spark: SparkSession, override: str) -> DataFrame:
    """Members of an override, a JSON object with values of any shape, as (bidder, document)."""
    members = spark.tvf.variant_explode(F.parse_json(F.lit(override)))
    return members.select(F.col("key").alias("bidder"), F.col("value").alias("document"))


def merge_overrides(documents: DataFrame, overrides: DataFrame) -> DataFrame:
    """Shallow merge: an override replaces its bidder's whole document or adds a new key."""
    kept = documents.join(overrides.select("bidder"), "bidder", "left_anti")
    return kept.unionByName(overrides.withColumn("part", F.lit(0)))


def _quoted(name: str) -> Column:
    """JSON text of a string column."""
    array = F.to_json(F.array(name))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def _opened(is_first: Column, first_in_parent: Column, key: str) -> Column:
    """Text opening an object at its first leaf, after a comma unless it leads its parent."""
    comma = _text_if(~first_in_parent, ",")
    return F.when(is_first, F.concat(comma, _quoted(key), F.lit(":{"))).otherwise("")


def _text_if(condition: Column, text: str) -> Column:
    return F.when(condition, text).otherwise("")


def document_lines(leaves: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """The published document as text lines, one per leaf or override, with their sort keys.

    Read in key order the lines are one JSON object. A line needs to know only whether it is the
    first or last of its country, continent, bidder and document; these come from minima and
    maxima, so no group is ever gathered and a bidder of any size is spread over many tasks.
    ``leaves`` must have one row per key, as ``distinct_leaves`` gives. They are read twice: once,
    when this is called, for the edges of every country, which are written, and once for the lines.
    """
    if overrides is not None:
        leaves = leaves.join(overrides.select("bidder"), "bidder", "left_anti")

    def edges(df: DataFrame, parents: Sequence[str], child: str) -> DataFrame:
        return df.groupBy(*parents).agg(
            F.min(child).alias(f"first_{child}"), F.max(child).alias(f"last_{child}")
        )

    countries = stage(edges(leaves, COUNTRY_KEYS, "host"), "edges")
    continents = edges(countries, COUNTRY_KEYS[:2], "country")
    bidders = edges(continents, COUNTRY_KEYS[:1], "continent")
    names = bidders.select("bidder")
    if overrides is not None:
        names = names.unionByName(overrides.select("bidder"))
    head = F.col("bidder") == names.agg(F.min("bidder")).scalar()
    tail = F.col("bidder") == names.agg(F.max("bidder")).scalar()

    first_host = F.col("host") == F.col("first_host")
    last_host = F.col("host") == F.col("last_host")
    first_country = first_host & (F.col("country") == F.col("first_country"))
    last_country = last_host & (F.col("country") == F.col("last_country"))
    first_continent = first_country & (F.col("continent") == F.col("first_continent"))
    last_continent = last_country & (F.col("continent") == F.col("last_continent"))
    nested = F.col("country") != DEFAULT
    rate = F.col("filter").cast("string")
    key = F.when(nested, _quoted("host")).otherwise(_quoted("country"))
    leads = F.when(nested, first_host).otherwise(first_country)
    line = F.concat(
        _text_if(head & first_continent, "{"),
        _opened(first_continent, head, "bidder"),
        _opened(first_country, first_continent, "continent"),
        _opened(first_host & nested, first_country, "country"),
        _text_if(~leads, ","),
        key,
        F.lit(":"),
        rate,
        _text_if(last_host & nested, "}"),
        _text_if(last_country, "}"),
        _text_if(last_continent, "}"),
        _text_if(tail & last_continent, "}"),
    )
    places = countries.join(continents, list(COUNTRY_KEYS[:2])).join(bidders, "bidder")
    lines = leaves.join(places, list(COUNTRY_KEYS)).select(*HOST_KEYS, line.alias("line"))
    if overrides is None:
        return lines
    return lines.unionByName(
        overrides.select(
            "bidder",
            F.concat(
                _text_if(head, "{"),
                _text_if(~head, ","),
                _quoted("bidder"),
                F.lit(":"),
                F.to_json("document"),
                _text_if(tail, "}"),
            ).alias("line"),
        ),
        allowMissingColumns=True,
    )
