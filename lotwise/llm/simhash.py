"""SimHash near-dedup: a byte-position inverted index with count filtering.

A fingerprint is eight bytes. Two fingerprints that differ in at most two bits differ in at most
two bytes, so they share at least six positional bytes. The index lists fingerprints by the bytes
they have at positions: a list of one position holds a 256th of all fingerprints and tallying over
it would meet a share of all pairs, so positions are taken in four groups of two and a list is kept
for every two groups. Of four groups two stay whole when two bytes differ, so a pair that has the
six matches meets in a list of four. The members of a list are paired, the positional bytes of
each pair are tallied, pairs below the six are dropped, and the rest are verified bit by bit.

Lists longer than a bound, such as those of a large group of near copies, are not paired. There
each member is listed again by itself and by every fingerprint one bit away, within the bits that
the list leaves open. Fingerprints are at most two bits apart exactly if they have such a
neighbour in common, and no neighbour has more members than bits, so this finds the links of a
list of any length with rows in proportion to it.

Equal fingerprints are one entry of the index, whatever the number of their documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.batches import sliced, views
from lotwise.llm.components import connected
from lotwise.sources.staging import stage

WORDS, HASH_SEED = 3, 42
# Bits that linked fingerprints may differ in, and the positional bytes they then share at least.
BITS, MATCHES = 2, 6
# Longest list whose members are paired. A member of a longer one costs a row for every open bit.
LIST_LIMIT = 32
# A fingerprint of at least this share of all rows is hot; there are at most as many hot ones.
HOT_SHARE = 1000
WINDOW = 1 << 20

_LOWER = bytes(range(ord("A"))) + bytes(range(ord("a"), ord("z") + 1)) + bytes(range(ord("Z") + 1, 256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def windows(text: memoryview, size: int = WINDOW) -> Iterator[bytes]:
    """The lower-cased text in parts of about ``size`` bytes that end before a white space."""
    start = 0
    while start < len(text):
        space = _SPACE.search(text, start + size)
        end = space.start() if space else len(text)
        yield bytes(text[start:end]).translate(_LOWER)
        start = end


def shingles(text: memoryview, words: int = WORDS) -> Iterator[list[bytes]]:
    """The shingles of a text in parts, repeats included; fewer words are one shingle."""
    carried: list[bytes] = []
    some = False
    for part in windows(text):
        own = carried + part.split()
        if len(own) >= words:
            some = True
            yield [b" ".join(s) for s in zip(*(own[i:] for i in range(words)))]
            carried = own[len(own) - words + 1 :]
        else:
            carried = own
    if not some and carried:
        yield [b" ".join(carried)]


def fingerprint(text: memoryview, words: int = WORDS) -> int:
    """64 bits, each set if it is in over half the hashes; zero without words."""
    counts, total = np.zeros(64, np.int64), 0
    for part in shingles(text, words):
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, HASH_SEED) for s in part), np.uint64, len(part))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(part)
    packed = np.packbits(counts * 2 > total, bitorder="little")
    return int(packed.view("<u8")[0])


def _printed(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = np.array([fingerprint(t, words) for t in views(batch.column(0))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found.view(np.int64))], ["_id", "_print"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``_id`` and ``_print``, the fingerprint as a signed integer, of every row."""
    rows = docs.select(F.col(text).alias("_text"), F.col(id_col).alias("_id"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(_printed(words), f"_id {kind}, _print long")


def _mask(groups: tuple[int, ...]) -> int:
    """The bits of some groups of two positions, as a signed integer."""
    mask = sum(0xFFFF << (16 * g) for g in groups)
    return mask - (1 << 64) if mask >> 63 else mask


GROUPS = list(combinations(range(4), 2))


def postings(codes: DataFrame) -> DataFrame:
    """A row per list a fingerprint is in: ``groups``, the number of the two groups of positions,
    ``bytes``, what the fingerprint has there, and the fingerprint."""
    lists = [
        F.struct(F.lit(i).alias("groups"), F.col("_print").bitwiseAND(_mask(g)).alias("bytes"))
        for i, g in enumerate(GROUPS)
    ]
    return codes.select("_print", F.explode(F.array(*lists)).alias("l")).select("l.groups", "l.bytes", "_print")


def tally(a: Column, b: Column) -> Column:
    """Positions at which two fingerprints have the same byte."""
    unlike = a.bitwiseXOR(b)
    same = [F.when(unlike.bitwiseAND(_byte(p)) == 0, 1).otherwise(0) for p in range(8)]
    return sum(same[1:], same[0])


def _byte(position: int) -> int:
    mask = 0xFF << (8 * position)
    return mask - (1 << 64) if mask >> 63 else mask


def paired(lists: DataFrame) -> DataFrame:
    """Links between the members of lists of bounded length."""
    key = ["groups", "bytes"]
    x, y = lists.select(*key, F.col("_print").alias("a")), lists.select(*key, F.col("_print").alias("b"))
    a, b = F.col("a"), F.col("b")
    pairs = x.join(y, key).filter(a < b).select("a", "b")
    enough = pairs.filter(tally(a, b) >= MATCHES)
    return enough.filter(F.bit_count(a.bitwiseXOR(b)) <= BITS)


def starred(lists: DataFrame) -> DataFrame:
    """Links that connect whatever is linked within lists of any length.

    The members of a neighbour differ from it in one bit each, so there are at most 33 of them and
    any two are linked; each is linked with the smallest.
    """
    bits = [[b for g in range(4) if g not in groups for b in range(16 * g, 16 * g + 16)] for groups in GROUPS]
    flips = [
        F.array(F.lit(0).cast("long"), *(F.lit((1 << b) - (1 << 64) if b == 63 else 1 << b).cast("long") for b in own))
        for own in bits
    ]
    chosen = F.array(*flips)[F.col("groups")]
    near = lists.select("groups", "bytes", "_print", F.explode(chosen).alias("flip"))
    near = near.withColumn("near", F.col("_print").bitwiseXOR(F.col("flip")))
    met = near.groupBy("groups", "bytes", "near").agg(F.array_sort(F.collect_list("_print")).alias("members"))
    met = met.filter(F.size("members") > 1).select(
        F.col("members")[0].alias("a"), F.explode(F.expr("slice(members, 2, size(members))")).alias("b")
    )
    return met


def links(codes: DataFrame, limit: int = LIST_LIMIT) -> DataFrame:
    """Links ``a`` < ``b`` between different fingerprints. They connect all fingerprints that are
    at most two bits apart; within lists of at most ``limit`` members every link is there."""
    key = ["groups", "bytes"]
    own = postings(codes)
    lengths = own.groupBy(*key).agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
    lists = stage(own.join(stage(lengths, "lengths"), key), "lists")
    found = paired(lists.filter(F.col("length") <= limit)).union(starred(lists.filter(F.col("length") > limit)))
    return stage(found.distinct(), "links")


def _joined(prints: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """Every row with its component. Hot fingerprints, of which there are at most ``HOT_SHARE``,
    are broadcast, so that their rows stay where they are; the others are shuffled."""
    hot = F.broadcast(found.filter(F.col("rows") * HOT_SHARE >= total).select("_print", "component_id"))
    cold = found.filter(F.col("rows") * HOT_SHARE < total).select("_print", "component_id")
    rest = prints.join(hot.select("_print"), "_print", "left_anti")
    return prints.join(hot, "_print").union(rest.join(cold, "_print").select("_print", "_id", "component_id"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    limit: int = LIST_LIMIT,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fingerprint`` (16 lowercase hex digits) and
    ``component_id``, the smallest identifier that links reach, the row's own included.

    Words are what white space separates, with A-Z as a-z. Two rows are linked if their
    fingerprints differ in at most two bits. A text that is null, empty or without words has the
    fingerprint zero and is linked like any other, a text of fewer words than a shingle is one
    shingle of all of them. Repeated rows and equal texts have the same fingerprint. A null
    identifier is never the smallest, unless all identifiers of a component are null. An empty
    table gives no rows; other columns are not read. ``limit`` changes costs, never results.
    """
    prints = stage(fingerprints(docs, id_col, text, words), "prints")
    counted = prints.groupBy("_print").agg(F.min("_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    codes = stage(counted, "codes")
    total = codes.agg(F.sum("rows")).first()[0] or 0
    roots = connected(links(codes, limit)).withColumnRenamed("node", "_print")
    found = codes.join(roots, "_print", "left").withColumn("root", F.coalesce("root", "_print"))
    least = found.groupBy("root").agg(F.min("least").alias("component_id"))
    found = stage(found.join(least, "root").select("_print", "rows", "component_id"), "components")
    return _joined(prints, found, total).select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
