"""N-gram Jaccard join: size-aware, with subsets for light sets and inverted lists for heavy ones.

Two sets can reach the similarity only if they share as many shingles as their sizes ask for. With
the shingles of all sets in one order, rarest first, sharing that many means sharing one of the
first few (the prefix), and two of a prefix longer by one. Large sets are found by scanning the
inverted lists of their prefix. Small sets enumerate all subsets of two shingles of their prefix,
keys that hardly ever meet by chance; the number of subsets grows with the square of the size, so
the size up to which this is cheaper than scanning lists is chosen by its cost on the data.

Sets equal to each other are one class and take part once. The members of a key are first checked
against one of them, and only members that are still unconnected after that are checked with each
other, so a large group of near copies costs as many checks as it has members. All counts are
exact on the shingles' 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.batches import small_batches
from lotwise.llm.components import connected
from lotwise.llm.rows import PLACE, located
from lotwise.llm.shingles import shingle_sets
from lotwise.sources.staging import stage

# Counters of the frequency sketch that orders shingles, and how it is added up: the sketch of a
# task comes in parts, and parts of the same number meet in groups of bounded size.
SKETCH_BITS, PART_BITS, FAN_IN = 20, 14, 1024
# Largest set sizes for which subsets are considered.
BOUNDARIES = (0, 2, 5, 10, 15, 20, 25, 30, 40, 50, 60, 80, 100, 150, 200, 300, 500, 1000)
# Bits of a set's parity bitmap, which rules out pairs of up to some thousand shingles; and members
# of a key that are paired without it, as they are too few to make many pairs.
PARITY_BITS, FEW = 512, 16
# Bits of the filter that spares texts without candidates a shuffle; 2 million words at most.
MAX_FILTER_BITS = 1 << 27
SLICE_BYTES = 4 << 20


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds few bytes of text, its first column."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(0)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // SLICE_BYTES
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
        for first, last in zip(starts, [*starts[1:], len(part)]):
            yield batch.slice(first, last - first)


def _sketched(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        shift = np.uint64(64 - SKETCH_BITS)
        for batch in _slices(batches):
            sets = list(shingle_sets(batch.column(0), words))
            if sets:
                slots = (np.concatenate(sets) >> shift).astype(np.int64)
                counts += np.bincount(slots, minlength=len(counts))
        if counts.any():
            parts = counts.reshape(-1, 1 << PART_BITS)
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array(range(len(parts)), pa.int32()), "counts": [p.tobytes() for p in parts]}
            )

    return run


def _summed(key: tuple, table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": [total.tobytes()]})


def rarity(docs: DataFrame, words: int) -> np.ndarray:
    """The level of every slot of the sketch: the bit length of its count over all texts.

    The sketch has a fixed size; shingles that share a slot share a level. It only orders
    shingles, so results do not depend on how well it tells them apart.
    """
    parts = docs.select("_text").mapInArrow(_sketched(words), "part int, counts binary")
    parts = parts.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(FAN_IN)))
    fields = "part int, counts binary"
    parts = parts.groupBy("part", "_salt").applyInArrow(_summed, fields)
    with small_batches(docs.sparkSession):
        found = parts.groupBy("part").applyInArrow(_summed, fields).collect()
    counts = np.zeros((1 << (SKETCH_BITS - PART_BITS), 1 << PART_BITS), np.int64)
    for part, own in found:
        counts[part] = np.frombuffer(own, np.int64)
    return np.ceil(np.log2(counts.ravel() + 1)).astype(np.uint8)


def least_shared(size, percent: int):
    """Shingles that a set shares at least with any set similar to it."""
    return -(-size * percent // 100)


def _signed(words: int, percent: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        shift = np.uint64(64 - SKETCH_BITS)
        for batch in _slices(batches):
            sizes, digests, prefixes, bitmaps = [], [], [], []
            for own in shingle_sets(batch.column(0), words):
                order = np.argsort(level[(own >> shift).astype(np.int64)], kind="stable")
                n = len(own)
                sizes.append(n)
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                prefixes.append(own[order[: n - least_shared(n, percent) + 2]].view(np.int64))
                slots = (own & np.uint64(PARITY_BITS - 1)).astype(np.int64)
                odd = np.bincount(slots, minlength=PARITY_BITS) & 1
                bitmaps.append(np.packbits(odd.astype(np.uint8)).view(np.int64).tolist())
            ends = np.cumsum([0, *map(len, prefixes)])
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array(sizes, pa.int32()),
                    pa.array(digests, pa.binary()),
                    lists,
                    pa.array(bitmaps, pa.list_(pa.int64())),
                ],
                [*batch.schema.names[1:], "n", "digest", "prefix", "bitmap"],
            )

    return run


def shared_rarity(docs: DataFrame, words: int):
    return docs.sparkSession.sparkContext.broadcast(rarity(docs, words))


def _id_type(docs: DataFrame) -> str:
    return docs.schema["_id"].dataType.simpleString()


def signatures(docs: DataFrame, words: int, percent: int, levels) -> DataFrame:
    """Of every row: the size and digest of its shingle set, its rarest shingles in order, and the
    parity of the number of its shingles in each of some slots."""
    kind = _id_type(docs)
    fields = f"_id {kind}, {PLACE[0]} string, {PLACE[1]} long, n int, digest binary, prefix array<long>, bitmap array<long>"
    rows = docs.select("_text", "_id", *PLACE)
    with small_batches(docs.sparkSession):
        return stage(rows.mapInArrow(_signed(words, percent, levels), fields), "signatures")


def classes_of(signed: DataFrame) -> DataFrame:
    """One row per distinct non-empty set, with a number and the place of one of its rows."""
    grouped = signed.filter("n > 0").groupBy("digest", "n")
    found = grouped.agg(
        F.min("_id").alias("least"),
        F.min(F.struct(*PLACE)).alias("at"),
        F.first("prefix").alias("prefix"),
        F.first("bitmap").alias("bitmap"),
    )
    return stage(found.withColumn("cls", F.monotonically_increasing_id()), "classes")


def _prefix_size(percent: int) -> Column:
    n = F.col("n")
    return (n - F.ceil(n * percent / 100) + 1).cast("int")


def _list_postings(classes: DataFrame, percent: int) -> DataFrame:
    """Every shingle of the prefix with its place and the shingle before it."""
    prefix = F.slice("prefix", F.lit(1), _prefix_size(percent))
    rows = classes.select("cls", "n", "prefix", F.posexplode(prefix).alias("pos", "key"))
    prev = F.when(F.col("pos") > 0, F.get("prefix", F.col("pos") - 1)).alias("prev")
    return rows.select("cls", "n", "pos", "key", prev)


def _subset_postings(classes: DataFrame) -> DataFrame:
    """Keys of all pairs of shingles of the prefix that is longer by one, with the place of the
    first and the shingles before the first and, if there is one between, before the second."""
    pairs = F.expr(
        "flatten(transform(sequence(1, size(prefix) - 1), i -> transform(sequence(i + 1, size(prefix)),"
        " j -> struct(i - 1 AS pos, xxhash64(prefix[i - 1], prefix[j - 1]) AS key,"
        " get(prefix, i - 2) AS prev, CASE WHEN j > i + 1 THEN prefix[j - 2] END AS between))))"
    )
    rows = classes.filter(F.size("prefix") > 1).select("cls", "n", F.explode(pairs).alias("p"))
    return rows.select("cls", "n", "p.*")


def boundary(classes: DataFrame, lists: DataFrame, percent: int) -> int:
    """The largest size for which enumerating subsets costs less than scanning lists.

    A subset costs one posting. A list posting costs itself and, where its list has more than one
    member, one check against the centre of the list. Sets just below the boundary also enter
    lists, for larger partners.
    """
    met = lists.agg(F.sum("len")).first()[0] or 0
    p, n = _prefix_size(percent).cast("double"), F.col("n")
    light = [F.sum(F.when(n <= x, p * (p + 1) / 2).otherwise(0.0)) for x in BOUNDARIES]
    heavy = [F.sum(F.when(n * 100 > x * percent, p).otherwise(0.0)) for x in BOUNDARIES]
    found = classes.agg(F.sum(p), *light, *heavy).first()
    if not found[0]:
        return 0
    scan = 1 + met / found[0]
    k = len(BOUNDARIES)
    costs = [found[1 + i] + scan * found[1 + k + i] for i in range(k)]
    return BOUNDARIES[costs.index(min(costs))]


def _shared_keys(postings: DataFrame) -> DataFrame:
    return postings.groupBy("key").agg(F.count(F.lit(1)).alias("len")).filter("len > 1")


def candidates(classes: DataFrame, percent: int, limit: int | None = None) -> DataFrame:
    """Postings of keys that several classes share: ``key``, ``cls``, ``n``, ``pos``, ``prev``,
    ``between`` and ``own``, the number of shingles that no other class has in its prefix.

    Every two similar classes share a key. ``limit`` sets the boundary instead of the cost.
    """
    postings = _list_postings(classes, percent)
    lists = stage(_shared_keys(postings), "lists")
    limit = boundary(classes, lists, percent) if limit is None else limit
    met = stage(postings.join(lists.select("key"), "key"), "met")
    own = (_prefix_size(percent) - F.count(F.lit(1))).alias("own")
    own = stage(met.groupBy("cls", "n").agg(own).select("cls", "own"), "own")
    heavy = met.filter(F.col("n") * 100 > limit * percent)
    subsets = _subset_postings(classes.filter(F.col("n") <= limit))
    light = subsets.join(stage(_shared_keys(subsets), "subsets").select("key"), "key")
    columns = ["key", "cls", "n", "pos", "prev", "between"]
    heavy = heavy.withColumn("between", F.lit(None).cast("long"))
    found = heavy.select(columns).union(light.select(columns)).join(own, "cls")
    return stage(found.select(*columns, "own"), "postings")


def _possible(left: str, right: str, percent: int) -> Column:
    """Whether two members of a key may be similar, if it is the first shingle in the order that
    they share, or the first two: then neither has any of the other's before it. Similar sets pass
    at their first key; at later ones they need not, and do not if the shingle before is the same."""
    n, m, i, j = (F.col(f"{side}.{c}") for c in ("n", "pos") for side in (left, right))
    shared = F.least(n - i, m - j)
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    later = [F.col(f"{left}.{c}") == F.col(f"{right}.{c}") for c in ("prev", "between")]
    first = ~F.coalesce(later[0], F.lit(False)) & ~F.coalesce(later[1], F.lit(False))
    return sizes & first & (shared * (100 + percent) >= (n + m) * percent)


def _pair(left: str, right: str) -> list[Column]:
    a, b = F.col(f"{left}.cls"), F.col(f"{right}.cls")
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def star_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Every member of a key with the one that has the fewest shingles of its own, in a group of
    near copies the one they were made from."""
    centre = postings.groupBy("key").agg(F.min(F.struct("own", "cls", "n", "pos", "prev", "between")).alias("centre"))
    rows = postings.alias("x").join(centre.select("key", "centre.*").alias("c"), "key")
    apart = F.col("x.cls") != F.col("c.cls")
    return rows.filter(apart & _possible("x", "c", percent)).select(*_pair("x", "c")).distinct()


def _even(left: str, right: str, percent: int) -> Column:
    """Whether the parities of two sets differ in no more slots than similar sets have shingles
    that are not shared; every slot that differs holds one such shingle at least."""
    words = range(PARITY_BITS // 64)
    differ = [F.bit_count(F.col(f"{left}.bitmap")[i].bitwiseXOR(F.col(f"{right}.bitmap")[i])) for i in words]
    total = F.col(f"{left}.n") + F.col(f"{right}.n")
    return sum(differ[1:], differ[0]) * (100 + percent) <= total * (100 - percent)


def open_pairs(
    postings: DataFrame, classes: DataFrame, roots: DataFrame, tested: DataFrame, percent: int
) -> DataFrame:
    """The members of a key that are still in different components, without pairs tested before.

    Of the two members one is outside the largest component of the key. Members that share a
    passage and little else, of which a key may have very many, are told apart by their parities
    within the join, so the pairs that leave it are few.
    """
    rows = postings.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    rows = rows.withColumn("root", F.coalesce("root", "cls"))
    sizes = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("key").agg(
        F.count(F.lit(1)).alias("roots"),
        F.sum("size").alias("members"),
        F.max(F.struct("size", "root")).alias("top"),
    )
    keys = largest.filter("roots > 1").select("key", "members", F.col("top.root").alias("top"))
    rows = stage(rows.join(keys, "key"), "open")
    many = rows.filter(F.col("members") > FEW).join(classes.select("cls", "bitmap"), "cls")
    few = _met(rows.filter(F.col("members") <= FEW), percent)
    found = few.union(_met(stage(many, "open-many"), percent, _even("x", "y", percent)))
    return found.distinct().join(tested, ["a", "b"], "left_anti")


def _met(rows: DataFrame, percent: int, condition: Column | None = None) -> DataFrame:
    outside = rows.filter("root != top").alias("x")
    possible = (F.col("x.root") != F.col("y.root")) & _possible("x", "y", percent)
    if condition is not None:
        possible &= condition
    return outside.join(rows.alias("y"), "key").filter(possible).select(*_pair("x", "y"))


def all_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Every two members of a key."""
    met = postings.alias("x").join(postings.alias("y"), "key")
    ordered = F.col("x.cls") < F.col("y.cls")
    return met.filter(ordered & _possible("x", "y", percent)).select(*_pair("x", "y")).distinct()


def _within_reach(percent: int, levels):
    shift = np.uint64(64 - SKETCH_BITS)

    def last(prefix: np.ndarray) -> tuple[int, int]:
        return int(levels.value[int(prefix[-1] >> shift)]), int(prefix[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y, n, m in zip(*(batch.column(i) for i in (2, 3, 4, 5))):
                x = x.values.to_numpy().view(np.uint64)
                y = y.values.to_numpy().view(np.uint64)
                n, m = n.as_py(), m.as_py()
                if last(x) > last(y):
                    x, y, n, m = y, x, m, n
                missed = len(x) - len(np.intersect1d(x, y, assume_unique=True))
                kept.append((n - missed) * (100 + percent) >= (n + m) * percent)
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    return run


def plausible(classes: DataFrame, pairs: DataFrame, percent: int, levels) -> DataFrame:
    """The pairs that their prefixes allow to be similar. Of two prefixes the one that ends first
    in the order has, beside what they share, only shingles that the other set lacks."""
    x = classes.select(F.col("cls").alias("a"), F.col("prefix").alias("x"), F.col("n").alias("nx"))
    y = classes.select(F.col("cls").alias("b"), F.col("prefix").alias("y"), F.col("n").alias("ny"))
    met = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", "nx", "ny")
    return stage(met.mapInArrow(_within_reach(percent, levels), "a long, b long"), "plausible")


def _bits_for(count: int) -> int:
    bits = 1 << 16
    while bits < min(16 * count, MAX_FILTER_BITS):
        bits *= 2
    return bits


def texts_of(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``cls`` and ``text`` of all classes in ``pairs``, the text of one row each.

    A bitmap of the wanted places, of a size that follows their number up to a bound, spares
    most other texts the shuffle; the join then finds the right ones.
    """
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    wanted = stage(classes.select("cls", "at.*").join(wanted, "cls"), "wanted")
    bits = _bits_for(wanted.count())
    bit = F.xxhash64(*PLACE).bitwiseAND(bits - 1)
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))
    word = F.shiftright(bit, 6).alias("word")
    bitmap = F.broadcast(wanted.groupBy(word).agg(F.bit_or(mask).alias("mask")))
    rows = docs.select("_text", *PLACE, word).join(bitmap, "word")
    rows = rows.filter(F.col("mask").bitwiseAND(mask) != 0).select("_text", *PLACE)
    return stage(rows.join(wanted, list(PLACE)).select("cls", F.col("_text").alias("text")), "texts")


def _similar(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            kept = []
            for x, y in zip(shingle_sets(batch.column(0), words), shingle_sets(batch.column(1), words)):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select([2, 3]).filter(pa.array(kept, pa.bool_()))

    return run


def linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs of classes that are similar, by all shingles of both texts."""
    texts = texts_of(docs, classes, pairs)
    x = texts.select(F.col("cls").alias("a"), F.col("text").alias("x"))
    y = texts.select(F.col("cls").alias("b"), F.col("text").alias("y"))
    met = pairs.join(x, "a").join(y, "b").select("x", "y", "a", "b")
    with small_batches(docs.sparkSession):
        return stage(met.mapInArrow(_similar(words, percent), "a long, b long"), "links")


def _rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return located(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")))


def similar_pairs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = 3,
    percent: int = 90,
    limit: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The whole join: all linked pairs of classes ``a`` and ``b``, and the class ``cls`` of every
    row as ``id_col``, ``n_shingles`` and ``cls``. Rows of one class have equal sets."""
    rows = _rows(docs, id_col, text)
    levels = shared_rarity(rows, words)
    signed = signatures(rows, words, percent, levels)
    classes = classes_of(signed)
    pairs = all_pairs(candidates(classes, percent, limit), percent)
    pairs = plausible(classes, pairs, percent, levels)
    members = signed.join(classes.select("digest", "n", "cls"), ["digest", "n"], "left")
    members = members.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "cls")
    return linked(rows, classes, pairs, words, percent), members


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = 3,
    percent: int = 90,
    limit: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles``, ``component_id``, and its place
    ``PLACE``.

    Two rows are linked if their sets of ``words``-word shingles have a Jaccard similarity of
    ``percent`` hundredths or more; ``component_id`` is the smallest identifier that links reach.
    A row of fewer words has all of them as its one shingle. A text that is null, empty or
    without words has no shingles and is linked with nothing, its component is itself. Repeated
    rows and equal texts have the same set and so one component. A null identifier is never the
    smallest, unless all identifiers of a component are null. Empty tables give no rows; other
    columns are not read. ``limit`` fixes the size up to which subsets are used.
    """
    rows = _rows(docs, id_col, text)
    levels = shared_rarity(rows, words)
    signed = signatures(rows, words, percent, levels)
    classes = classes_of(signed)
    postings = candidates(classes, percent, limit)

    tested = stage(star_pairs(postings, percent), "star")
    near = plausible(classes, tested, percent, levels)
    roots = connected(linked(rows, classes, near, words, percent))
    rest = plausible(classes, open_pairs(postings, classes, roots, tested, percent), percent, levels)
    if not rest.isEmpty():
        more = linked(rows, classes, rest, words, percent)
        own = roots.select(F.col("node").alias("b"), F.col("root").alias("a"))
        roots = connected(own.select("a", "b").union(more))

    found = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    found = found.withColumn("root", F.coalesce("root", "cls"))
    least = found.groupBy("root").agg(F.min("least").alias("component_id"))
    found = found.select("digest", "n", "root").join(least, "root")
    whole = signed.select("_id", *PLACE, "digest", "n").join(found, ["digest", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("_id")).otherwise(F.col("component_id"))
    return whole.select(
        F.col("_id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        *PLACE,
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with its smallest
    identifier stays, of repetitions of that the first by place. Rows without words all stay."""
    columns = docs.columns
    docs = located(docs)
    found = near_duplicates(docs, id_col, text, words, percent)
    first = F.min(F.struct(*PLACE)).alias("first")
    named = F.col(id_col).eqNullSafe(F.col("component_id")) & (F.col("n_shingles") > 0)
    chosen = found.filter(named).groupBy("component_id").agg(first)
    kept = found.filter("n_shingles = 0").select(*PLACE).union(chosen.select("first.*"))
    return docs.join(kept, list(PLACE), "left_semi").select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).drop(*PLACE)
