import zlib
from collections import defaultdict

import pytest
from corpus import SF_DIR, documents
from pyspark.sql import functions as F

from lotwise.llm import sharding
from lotwise.llm.sharding import shard_documents


def check_slots(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return slots


def loads(rows):
    total = defaultdict(int)
    for r in rows:
        total[r["shard"]] += r["size"]
    return total


def test_query_over_whole_documents(spark):
    rows = sharding.query(spark, SF_DIR).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
    check_slots(rows)
    total = loads(rows)
    assert set(total) == set(range(16))
    mean, largest = sum(total.values()) / 16, max(r["size"] for r in rows)
    assert max(abs(x - mean) for x in total.values()) <= largest
    homes = defaultdict(set)
    for r in rows:
        homes[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_any_number_of_shards(spark, shards):
    docs = documents(spark, [f"text {i} " + "x" * (i % 50) for i in range(2000)])
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.concat(F.lit("s"), F.col("doc_id") % 5)})
    total = loads(shard_documents(docs, shards=shards).collect())
    mean = sum(total.values()) / shards
    assert len(total) == shards and max(abs(x - mean) for x in total.values()) < 0.02 * mean + 120


def test_target_bytes_gives_the_number_of_shards(spark):
    docs = documents(spark, ["x" * 99 + str(i) for i in range(1000)])
    dims = {"id": F.col("doc_id")}
    total = loads(shard_documents(docs, target_bytes=10_000, dims=dims).collect())
    assert len(total) == 11 and max(total.values()) <= 10_000


def test_a_group_larger_than_a_shard_is_cut_and_a_smaller_one_is_not(spark):
    texts = ["same" * 10] * 1000 + [f"{i:040d}" for i in range(1000)] + ["pair" * 10] * 100
    rows = shard_documents(documents(spark, texts), shards=4, dims={"id": F.col("doc_id")}).collect()
    total = loads(rows)
    mean = sum(total.values()) / 4
    assert max(abs(x - mean) for x in total.values()) < 0.05 * mean
    assert len({r["shard"] for r in rows if r["doc_id"] < 1000}) > 1
    assert len({r["shard"] for r in rows if r["doc_id"] >= 2000}) == 1


def test_nulls_repeated_rows_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, 1), (1, None, None, None, 2), (None, "", "en", "s", 3), (2, "é", "en", "s", 4)],
        "doc_id long, text string, lang string, source string, shard int",
    )
    rows = shard_documents(docs, shards=2).collect()
    assert sorted(r["size"] for r in rows) == [1, 1, 1, 3]
    check_slots(rows)
    assert shard_documents(docs.limit(0), shards=2).collect() == []


def test_strings_are_told_apart_behind_their_common_beginning(spark):
    names = [f"common-crawl-{i:02d}" for i in range(50)] + [None]
    docs = spark.createDataFrame([(n,) for n in names], "source string")
    rows = docs.select("source", sharding.codes(docs, ["source"])["source"].alias("code")).collect()
    assert len({r["code"] for r in rows}) == 51
    ordered = sorted(rows, key=lambda r: r["code"])
    assert [r["source"] for r in ordered] == [None, *names[:-1]]
    for few in ([], ["é"], ["a", "ab"], ["", None], [None]):
        docs = spark.createDataFrame([(n,) for n in few], "source string")
        found = docs.select("source", sharding.codes(docs, ["source"])["source"].alias("code")).collect()
        assert len({r["code"] for r in found}) <= max(1, len(few))


def test_sources_with_one_beginning_are_a_dimension(spark):
    """Two kinds of documents that only their sources tell apart meet in no shard but one."""
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.lpad("id", 50, "0").alias("text"), F.lit("en").alias("lang"),
        F.concat(F.lit("common-crawl-"), F.when(F.xxhash64("id") % 2 == 0, "aaaa").otherwise("zzzz")).alias("source"),
    )
    dims = {"source": sharding.codes(docs, ["source"])["source"]}
    placed = shard_documents(docs, shards=4, dims=dims).join(docs.select("doc_id", "source"), "doc_id")
    homes = defaultdict(set)
    for r in placed.collect():
        homes[r["shard"]].add(r["source"])
    assert sum(len(h) for h in homes.values()) <= 5
