"""Exact top-k search in Hamming space by incremental multi-index hashing.

Vectors become binary codes, a bit for the sign of each dimension, and codes are cut into segments
of 16 bits that index them. If two codes differ in t = m * s + j bits (m segments, j < m), one of
the first j + 1 segments differs in at most s bits or another one in at most s - 1. So searching
all segment values at growing distance, segment by segment, covers one more bit at each step. A
query is done when the distance of its kth verified neighbour is covered.

Equal codes are one entry of the index, with as many of their smallest identifiers as an answer
can need, so a code shared by very many rows is met once.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.sources.staging import stage

WORD, SEGMENT = 64, 16
K = 10
SALT = 32


def _code(vector: Column, word: int) -> Column:
    """Bits of 64 dimensions: 1 for a positive number, 0 for any other value and beyond the end."""
    part = F.slice(vector, word * WORD + 1, WORD)
    one = F.lit(1).cast("long")
    positive = lambda x: (x > 0) & ~F.isnan(x)
    bits = F.transform(
        part,
        lambda x, i: F.when(positive(x), F.call_function("shiftleft", one, i)).otherwise(F.lit(0).cast("long")),
    )
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def _names(words: int, side: str = "c") -> list[str]:
    return [f"{side}{w}" for w in range(words)]


def _distance(words: int) -> Column:
    parts = [F.bit_count(F.col(q).bitwiseXOR(F.col(c))) for q, c in zip(_names(words, "q"), _names(words))]
    return reduce(lambda a, b: a + b, parts).cast("int")


def _key(segment: int, side: str) -> Column:
    """The value of a segment with its number in front."""
    word, shift = divmod(segment * SEGMENT, WORD)
    value = F.shiftrightunsigned(F.col(f"{side}{word}"), shift).bitwiseAND((1 << SEGMENT) - 1)
    return value.bitwiseOR(F.lit(segment << SEGMENT).cast("long"))


def _masks(weight: int) -> Column:
    """All segment values with ``weight`` bits, as one literal array."""
    values = [sum(1 << b for b in bits) for bits in combinations(range(SEGMENT), weight)]
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _rounds(segments: int) -> list[range]:
    """Steps searched together: the cheap ones up to one bit a segment, which bound the distance of
    most queries, then a whole radius, from the fifth bit on one segment at a time."""
    last = segments * (SEGMENT + 1)
    rounds = [range(0, 2 * segments), *(range(r * segments, (r + 1) * segments) for r in (2, 3, 4))]
    return rounds + [range(t, t + 1) for t in range(5 * segments, last)]


def _codes(points: DataFrame, words: int, most: int) -> DataFrame:
    """Different codes: number ``cid``, ``ids`` (the smallest ``most``), ``least`` and ``size``.

    The smallest identifiers are taken in salted parts of a code first, so no task sees more of a
    code's rows than a part of them and what the parts left.
    """
    code = _names(words)
    part = points.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT)))
    first = F.row_number().over(Window.partitionBy(*code, "salt").orderBy("id"))
    few = part.withColumn("n", first).filter(F.col("n") <= most).drop("n", "salt")
    again = F.row_number().over(Window.partitionBy(*code).orderBy("id"))
    few = few.withColumn("n", again).filter(F.col("n") <= most)
    found = few.groupBy(*code).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    found = found.select(*code, "ids", F.col("ids")[0].alias("least"), F.size("ids").alias("size"))
    return stage(found.withColumn("cid", F.monotonically_increasing_id()), "codes")


def _index(codes: DataFrame, words: int) -> DataFrame:
    segments = words * WORD // SEGMENT
    keys = F.explode(F.array(*[_key(j, "c") for j in range(segments)])).alias("key")
    return stage(codes.select(keys, "cid", "least", "size", *_names(words)), "segments")


def _met(open_queries: DataFrame, index: DataFrame, steps: range, words: int) -> DataFrame:
    """Verified neighbours of one round, not farther than what a query already has."""
    segments = words * WORD // SEGMENT
    asked = None
    for radius in sorted({t // segments for t in steps}):
        own = [t % segments for t in steps if t // segments == radius]
        keys = F.explode(F.array(*[_key(j, "q") for j in own])).alias("at")
        rows = open_queries.select("qid", "bound", *_names(words, "q"), keys)
        mask = F.explode(_masks(radius)).alias("mask")
        rows = rows.select("qid", "bound", *_names(words, "q"), "at", mask)
        rows = rows.withColumn("key", F.col("at").bitwiseXOR(F.col("mask"))).drop("at", "mask")
        asked = rows if asked is None else asked.union(rows)
    # The planner sees what masks are made from, not their number, so it must not broadcast them.
    near = asked.join(index.hint("merge"), "key").withColumn("distance", _distance(words))
    near = near.filter(F.col("distance") <= F.col("bound"))
    return near.select("qid", "cid", "distance", "least", "size").distinct()


def _nearest(found: DataFrame, most: int) -> DataFrame:
    """Of each query the first ``most`` codes by distance and smallest identifier. An answer of
    ``most`` identifiers never needs another one, as every code before it has its own."""
    order = Window.partitionBy("qid").orderBy("distance", "least", "cid")
    ranked = found.withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= most).drop("place")


def _search(codes: DataFrame, asked: DataFrame, words: int, most: int) -> DataFrame:
    """``qid``, ``cid`` and ``distance`` of codes that hold the nearest identifiers."""
    spark = codes.sparkSession
    index = _index(codes, words)
    far = words * WORD
    columns = [F.col(c).alias(q) for c, q in zip(_names(words), _names(words, "q"))]
    queries = stage(asked.select(F.col("cid").alias("qid"), *columns), "queries")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    open_queries = queries.withColumn("bound", F.lit(far)).repartition(partitions, "qid")
    done = best = None
    for steps in _rounds(words * WORD // SEGMENT):
        found = _met(open_queries, index, steps, words)
        best = stage(_nearest(found if best is None else best.union(found).distinct(), most), "nearest")
        upto = Window.partitionBy("qid").orderBy("distance").rangeBetween(Window.unboundedPreceding, 0)
        reached = best.withColumn("upto", F.sum("size").over(upto)).filter(F.col("upto") >= most)
        bounds = reached.groupBy("qid").agg(F.min("distance").alias("bound"))
        bounded = queries.join(bounds, "qid", "left").withColumn("bound", F.coalesce("bound", F.lit(far)))
        covered = steps[-1]
        rest = stage(bounded.filter(F.col("bound") > covered), "open")
        ended = best.join(rest.select("qid"), "qid", "left_anti")
        done = ended if done is None else done.union(ended)
        queries = rest.drop("bound")
        if rest.isEmpty() or covered >= far:
            return done.union(best.join(rest.select("qid"), "qid", "left_semi"))
        best = stage(best.join(rest.select("qid"), "qid", "left_semi"), "nearest")
        open_queries = rest.repartition(partitions, "qid")
    return done


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """For every row for which ``queries`` holds: ``query_id``, ``rank``, ``id_col``, ``distance``
    of its ``k`` nearest other rows, by Hamming distance of the codes and then by identifier.

    Results are exact. Rows without vector or identifier are neither asked nor found; a missing
    or undefined number counts as not positive, as do dimensions that a shorter vector lacks.
    Rows that repeat an identifier with the same code are one row. With fewer than ``k`` other
    rows a query has as many results; an empty table gives none. Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"), queries.alias("asked"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
    dims = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    words = -(-dims // WORD)
    code = [_code(F.col("vector"), w).alias(c) for w, c in enumerate(_names(words))]
    points = stage(rows.select("id", "asked", *code).distinct(), "points")
    codes = _codes(points.select("id", *_names(words)).distinct(), words, k + 1)
    asked = points.filter("asked").select("id", *_names(words)).join(codes.drop("ids", "least", "size"), _names(words))
    asked = stage(asked.select("id", "cid").distinct(), "asked")
    wanted = codes.join(asked.select("cid").distinct(), "cid", "left_semi")

    near = _search(codes, wanted, words, k + 1)
    listed = near.join(codes.select("cid", "ids"), "cid").select("qid", "distance", F.explode("ids").alias("found"))
    order = Window.partitionBy("qid").orderBy("distance", "found")
    listed = listed.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    mine = asked.withColumnRenamed("cid", "qid").join(listed, "qid")
    others = mine.filter((F.col("distance") > 0) | (F.col("found") != F.col("id")))
    place = F.row_number().over(Window.partitionBy("id").orderBy("distance", "found"))
    ranked = others.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), "rank", F.col("found").alias(id_col), "distance")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 20 == 0)


ORACLE = f"""
WITH pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id,
        CAST(list_sum([CASE WHEN (q.embedding[i] > 0) <> (v.embedding[i] > 0) THEN 1 ELSE 0 END
            FOR i IN range(1, len(q.embedding) + 1)]) AS INTEGER) AS distance
    FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, vec_id, distance,
        CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank
    FROM pairs
)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= {K}
"""
