import random
import re

import numpy as np
import pytest
import xxhash
from corpus import SF_DIR, documents
from pyspark.sql import functions as F

from lotwise.llm import simhash
from lotwise.llm.simhash import fingerprint, links, near_duplicates, postings


def plain_fingerprint(text, words=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)]
    if found and not shingles:
        shingles = [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def all_links(codes, bits=2):
    codes = np.array(codes, np.uint64)
    return {
        (i, j)
        for i in range(len(codes))
        for j in np.flatnonzero(np.bitwise_count(codes[i] ^ codes[i + 1 :]) <= bits) + i + 1
    }


def classes(n, pairs):
    root = list(range(n))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        i, j = sorted((top(i), top(j)))
        root[j] = i
    return [top(i) for i in range(n)]


def by_all_pairs(rows):
    """Fingerprint and component of every row, from all pairs of different fingerprints."""
    codes = sorted({plain_fingerprint(t) for _, t in rows})
    of = dict(zip(codes, classes(len(codes), all_links(codes))))
    least = {}
    for i, t in rows:
        c = of[plain_fingerprint(t)]
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted(
        (i is None, i, f"{f:016x}", least.get(of[f])) for i, t in rows for f in [plain_fingerprint(t)]
    )


def found(df):
    return sorted((r["doc_id"] is None, r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect())


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(simhash.query(spark, SF_DIR)) == by_all_pairs(rows)


def near(centre, draw, most):
    for bit in draw.sample(range(64), draw.randrange(most + 1)):
        centre ^= 1 << bit
    return centre


@pytest.mark.parametrize("limit", [1, 4, 32, 10_000])
def test_links_connect_what_is_two_bits_apart_at_any_limit(spark, limit):
    draw = random.Random(limit)
    codes = {draw.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1, 1 << 63}
    for centre in list(codes)[:40]:
        codes |= {near(centre, draw, 4) for _ in range(20)}
    codes |= {near(0, draw, 5) for _ in range(400)}
    codes = sorted(codes)
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    at = {s[0]: i for i, s in enumerate(signed)}
    rows = links(spark.createDataFrame(signed, "_print long"), limit).collect()
    got = {tuple(sorted((at[r["a"]], at[r["b"]]))) for r in rows}
    wanted = all_links(codes)
    assert got <= wanted
    assert classes(len(codes), got) == classes(len(codes), wanted)
    if limit == 10_000:
        assert got == wanted


def test_every_link_meets_in_a_list_with_six_matches(spark):
    draw = random.Random(5)
    pairs = [(c, near(c, draw, 2)) for c in (draw.getrandbits(64) for _ in range(500))]
    signed = [tuple(v - (1 << 64) if v >> 63 else v for v in p) for p in pairs]
    df = spark.createDataFrame(signed, "a long, b long")
    assert df.filter(simhash.tally(F.col("a"), F.col("b")) < simhash.MATCHES).count() == 0
    lists = [
        postings(df.select(F.col(c).alias("_print"), F.struct("a", "b").alias("p"))).collect() for c in "ab"
    ]
    own = [{(r["groups"], r["bytes"]) for r in side} for side in lists]
    assert own[0] & own[1]


def test_rows_of_long_lists_grow_with_the_list(spark):
    """A third of all fingerprints in one group of near copies."""
    draw = random.Random(9)
    for size in (500, 2000):
        codes = {near(0, draw, 5) for _ in range(size)}
        lists = postings(spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "_print long"))
        assert simhash.starred(lists).count() <= lists.count() * 33


TEXTS = [
    "", None, "\n\t ", "one", "One", "one two", "one two three", "a b c d e f g", "A  b\x0bc\td e f G",
    "café au lait " * 5, "CAFÉ au lait " * 5, "x y z w", "word " * 400_000, "w" * 3_000_000 + " a b",
    " ".join(f"w{i % 5000}" for i in range(300_000)),
]


def test_odd_texts_ties_nulls_and_repeated_rows(spark):
    rows = [(i % 20 + 7, t) for i, t in enumerate(TEXTS * 2)] + [(None, ""), (None, "alone here now"), (3, "one"), (3, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"fingerprint": F.lit(1), "_print": F.lit("x"), "component_id": F.lit(None).cast("int")}
    )
    got = near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert found(got) == by_all_pairs(rows)


@pytest.mark.parametrize("size", [1, 5, 64])
def test_windows_do_not_change_fingerprints(monkeypatch, size):
    monkeypatch.setattr(simhash, "windows", lambda text: list(WINDOWS(text, size)))
    for text in ("a b c d e f", "  lead and trail  ", "Ab\ncd\x0cEF gh é ü", "x" * 200 + " y z"):
        assert fingerprint(memoryview(text.encode())) == plain_fingerprint(text)


WINDOWS = simhash.windows


def test_empty_table(spark):
    assert near_duplicates(documents(spark, ["x"]).limit(0)).collect() == []
