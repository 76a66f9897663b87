"""Filter interaction audit by decision diagrams.

Every document has a mask of the filters it fails. Spark counts documents per part and mask, so a
part comes down to at most 2^m rows for m filters. From these a decision diagram is built per part:
one level per filter, two edges per node (passes, fails), equal subdiagrams shared, every node
weighted with the counts below it. A filter order is an order of levels. All orders are reached
from the first by swapping adjacent levels, which touches the nodes of two levels only; the path of
passes from the root then gives what every step of that order keeps and removes.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.sources.staging import stage

WORDS = r"[\x20\x09-\x0D]+"
FILTERS = "ABCDE"
# All orders are visited, so their number is bounded; masks are far fewer.
MOST_FILTERS = 8

Weight = tuple[int, ...]


class Diagram:
    """An ordered decision diagram whose terminals are count vectors.

    Every path passes all levels, so a node's weight is the sum of its two subdiagrams' weights.
    """

    def __init__(self, counts: Mapping[int, Weight], filters: int, width: int) -> None:
        self.order = list(range(filters))
        self.low: list[int] = []
        self.high: list[int] = []
        self.weight: list[Weight] = []
        terminals: dict[Weight, int] = {}
        row = []
        for place in range(1 << filters):
            # The first level is the highest bit of the place, filter 0 the lowest bit of a mask.
            mask = int(f"{place:0{filters}b}"[::-1], 2) if filters else 0
            weight = counts.get(mask, (0,) * width)
            if weight not in terminals:
                terminals[weight] = self._node(-1, -1, weight)
            row.append(terminals[weight])
        self.levels: list[dict[tuple[int, int], int]] = [{} for _ in range(filters)]
        for level in reversed(range(filters)):
            row = [self._make(level, *row[i : i + 2]) for i in range(0, len(row), 2)]
        self.root = row[0]

    def _node(self, low: int, high: int, weight: Weight) -> int:
        self.low.append(low)
        self.high.append(high)
        self.weight.append(weight)
        return len(self.weight) - 1

    def _make(self, level: int, low: int, high: int) -> int:
        """The node of a level with these subdiagrams, shared with an equal one."""
        known = self.levels[level]
        if (low, high) not in known:
            total = tuple(a + b for a, b in zip(self.weight[low], self.weight[high]))
            known[low, high] = self._node(low, high, total)
        return known[low, high]

    def swap(self, level: int) -> None:
        """Exchange a level with the next. Nodes above keep their edges, as the nodes they point to
        are rewritten in place and stand for the same function."""
        upper = list(self.levels[level].values())
        self.levels[level], self.levels[level + 1] = {}, {}
        for node in upper:
            low, high = self.low[node], self.high[node]
            passes = self._make(level + 1, self.low[low], self.low[high])
            fails = self._make(level + 1, self.high[low], self.high[high])
            self.low[node], self.high[node] = passes, fails
            self.levels[level][passes, fails] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def passes(self) -> Iterator[tuple[int, Weight, Weight]]:
        """Filter, weight kept and weight removed of every step down the path of passes."""
        node = self.root
        for name in self.order:
            yield name, self.weight[self.low[node]], self.weight[self.high[node]]
            node = self.low[node]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places of the adjacent swaps that visit all orders of ``n`` things, each once.

    The last thing travels through an order of the others, back and forth; at each end the others
    make one swap of their own.
    """
    if n < 2:
        return
    down = True
    for inner in [*adjacent_swaps(n - 1), None]:
        yield from reversed(range(n - 1)) if down else range(n - 1)
        if inner is not None:
            yield inner + 1 if down else inner
        down = not down


def audited(counts: Mapping[int, Weight], names: str, width: int) -> list[tuple]:
    """Order, step and figures of every step of every order of the filters, for one part."""
    diagram = Diagram(counts, len(names), width)
    paths = [(tuple(diagram.order), list(diagram.passes()))]
    for level in adjacent_swaps(len(names)):
        diagram.swap(level)
        paths.append((tuple(diagram.order), list(diagram.passes())))
    fails, unique, shapley = {}, {}, dict.fromkeys(range(len(names)), 0)
    for _, path in paths:
        # The first filter removes all that fail it, the last one what fails no other.
        fails[path[0][0]] = path[0][2][0]
        unique[path[-1][0]] = path[-1][2][0]
        for name, _, removed in path:
            shapley[name] += removed[0]
    rows = []
    for order, path in paths:
        spelled = "".join(names[i] for i in order)
        for step, (name, kept, removed) in enumerate(path, 1):
            own = (kept[0], removed[0], fails[name] - removed[0], unique[name], *removed[1:], shapley[name])
            rows.append((spelled, step, *own))
    return rows


def audit(
    judged: DataFrame, filters: str = FILTERS, part: str = "part", mask: str = "mask", count: str = "n",
    lost: tuple[str, ...] = (),
) -> DataFrame:
    """Per part, order of ``filters`` and step: ``part``, ``filter_order``, ``step``, ``kept``,
    ``removed``, ``redundant``, ``unique_fails``, a ``<name>_lost`` for every column of ``lost``
    and ``shapley``.

    ``judged`` counts documents (``count`` and, among them, the columns of ``lost``) by part and
    mask, in which bit i is set if filter i is failed; repeated part and mask add up and missing
    counts are 0. A null part is the empty string, a null mask fails nothing. An empty table has
    no parts and so gives no rows. Other columns are not read.
    """
    if not 0 < len(filters) <= MOST_FILTERS or len(set(filters)) < len(filters):
        raise ValueError(f"between one and {MOST_FILTERS} different filters, not {filters!r}")
    weights = ["_w0", *(f"_w{i}" for i in range(1, len(lost) + 1))]
    sums = [F.coalesce(F.sum(F.col(c)), F.lit(0)).cast("long").alias(w) for w, c in zip(weights, (count, *lost))]
    keys = [
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"),
        F.coalesce(F.col(mask).cast("long"), F.lit(0).cast("long")).bitwiseAND((1 << len(filters)) - 1).alias("_mask"),
    ]
    counted = judged.groupBy(*keys).agg(*sums)
    names = ["kept", "removed", "redundant", "unique_fails", *(f"{c}_lost" for c in lost), "shapley"]

    def of_part(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts = {int(m): tuple(map(int, w)) for m, *w in rows[["_mask", *weights]].itertuples(index=False)}
        found = pd.DataFrame(audited(counts, filters, len(weights)), columns=["filter_order", "step", *names])
        return found.assign(part=key[0])

    fields = ", ".join(["part string", "filter_order string", "step int", *(f"{c} long" for c in names)])
    columns = ["part", "filter_order", "step", *names]
    return counted.groupBy("_part").applyInPandas(
        lambda key, rows: of_part(key, rows)[columns], fields
    )


def text_failures(text: Column) -> list[Column]:
    """The conditions A to D on a text that is not null."""
    words = F.filter(F.split(text, WORDS), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        F.size(words) < 200,
        F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        capitals.cast("long") * 100 > F.length(text).cast("long") * 3,
        text.rlike("[#$%&*|]"),
    ]


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per ``part`` and ``mask`` of the filters A to E: ``n``, ``good`` and ``toxic``.

    A null text is an empty one, a null language the part of the empty string. Texts are identical
    if their SHA-256 digests are. A row whose identifier is null is no earlier nor later than any
    other, and rows that repeat an identifier do not repeat each other. A document is good, or
    toxic, if any label row of its identifier says so; without one it is neither.

    Only digests are shuffled. The earliest row of a digest is found by an aggregation and met by
    digest and identifier together, so a text that a third of all rows share is spread out.
    """
    text = F.coalesce("text", F.lit(""))
    failed = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(text_failures(F.col("text")))]
    part = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
    rows = docs.select(F.col("doc_id").alias("_id"), part, text.alias("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    rows = rows.select("_id", "part", digest, sum(failed[1:], failed[0]).alias("mask"))
    slim = stage(rows.groupBy("_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")), "masks")

    firsts = slim.groupBy("digest").agg(F.min("_id").alias("_id"))
    firsts = firsts.filter("_id IS NOT NULL").withColumn("first", F.lit(True))
    known = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    met = slim.join(firsts, ["_id", "digest"], "left").join(known, "_id", "left")
    repeated = F.col("_id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask") + F.when(repeated, F.lit(16)).otherwise(F.lit(0))
    return met.groupBy("part", mask.alias("mask")).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return audit(failure_counts(docs, labels), lost=("good", "toxic"))


ORACLE = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), known AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
        max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), judged AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(words) < 200 THEN 1 ELSE 0 END AS a,
        CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 1 ELSE 0 END AS b,
        CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text) THEN 1 ELSE 0 END AS c,
        CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
        CASE WHEN texts.doc_id > min(texts.doc_id) OVER (PARTITION BY text) THEN 1 ELSE 0 END AS e
    FROM texts LEFT JOIN known ON texts.doc_id = known.doc_id
), counted AS (
    SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM judged GROUP BY ALL
), letters AS (
    SELECT unnest([1, 2, 3, 4, 5]) AS x
), orders AS (
    SELECT [p.x, q.x, r.x, s.x, t.x] AS places
    FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (
    SELECT places, step, places[step] AS own,
        array_to_string([substr('ABCDE', x, 1) FOR x IN places], '') AS filter_order
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), outcomes AS (
    SELECT part, filter_order, step, own, n, good, toxic, fails[own] = 1 AS failed,
        list_sum([fails[x] FOR x IN places[1:step - 1]]) > 0 AS earlier,
        list_sum(fails) AS failures
    FROM counted, steps
), figures AS (
    SELECT part, filter_order, step, own,
        sum(CASE WHEN NOT failed AND NOT coalesce(earlier, false) THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN failed AND NOT coalesce(earlier, false) THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN failed AND coalesce(earlier, false) THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN failed AND failures = 1 THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN failed AND NOT coalesce(earlier, false) THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN failed AND NOT coalesce(earlier, false) THEN toxic ELSE 0 END) AS toxic_lost
    FROM outcomes GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
    CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
    CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
    CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM figures
"""
