import random
import re

import numpy as np
import pyarrow as pa
import pytest
from corpus import SF_DIR, documents
from pyspark.sql import functions as F

from lotwise.llm import ngram_join, shingles
from lotwise.llm.components import connected
from lotwise.llm.ngram_join import PLACE, keep_one, near_duplicates, similar_pairs


def shingle_set(text, words):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0d]+", lower)
    if len(found) < words:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def links(sets, percent):
    order = sorted((i for i in sets if sets[i]), key=lambda i: len(sets[i]))
    for at, i in enumerate(order):
        for j in order[at + 1 :]:
            a, b = sets[i], sets[j]
            if len(a) * 100 < percent * len(b):
                break
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                yield i, j


def brute_force(texts, words, percent):
    sets = {i: shingle_set(t, words) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links(sets, percent):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def variants(seed, groups=25, copies=6):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(1, 90))
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own[: rng.randint(len(own) * 9 // 10, len(own))]))
    return texts


@pytest.mark.parametrize("words, percent, limit", [(3, 90, None), (5, 80, None), (3, 90, 1000)])
def test_whole_documents_against_brute_force(spark, words, percent, limit):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = result(near_duplicates(docs, words=words, percent=percent, limit=limit))
    assert got == brute_force(texts, words, percent)


@pytest.mark.parametrize("limit", [0, 20, 1000])
def test_chains_of_edits_on_both_sides_of_the_boundary(spark, limit):
    texts = dict(enumerate(variants(limit)))
    got = result(near_duplicates(documents(spark, texts.values()), words=1, percent=60, limit=limit))
    assert got == brute_force(texts, 1, 60)


def test_a_common_passage_does_not_link_but_near_copies_do(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    own = [" ".join(f"d{n}x{i}" for i in range(80)) for n in range(60)]
    copies = [" ".join(f"c{i}" if i != n else "edit" for i in range(200)) for n in range(150)]
    texts = dict(enumerate([f"{passage} {t}" for t in own] + copies))
    got = result(near_duplicates(documents(spark, texts.values())))
    assert got == brute_force(texts, 3, 90)
    assert {got[i][1] for i in range(60, 210)} == {60} and len({got[i][1] for i in range(60)}) == 60


def test_join_gives_every_pair_between_different_sets(spark):
    texts = dict(enumerate(variants(9, groups=8)))
    pairs, members = similar_pairs(documents(spark, texts.values()), words=2, percent=70)
    sets = {i: shingle_set(t, 2) for i, t in texts.items()}
    of = {r["cls"]: sets[r["doc_id"]] for r in members.collect()}
    got = {frozenset((of[r["a"]], of[r["b"]])) for r in pairs.collect()}
    assert got == {frozenset((sets[i], sets[j])) for i, j in links(sets, 70) if sets[i] != sets[j]}


def test_nulls_empty_short_and_repeated_rows(spark):
    rows = [(3, None), (4, ""), (5, " \t"), (6, "one two"), (2, "ONE two"), (7, "one"), (6, "one two"), (None, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash"))
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in near_duplicates(docs).collect())
    assert got == [(0, 1, 2), (2, 1, 2), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 2), (6, 1, 2), (7, 1, 7)]
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5, 7]
    assert near_duplicates(docs.limit(0)).drop(*PLACE).collect() == []


def test_shingles_against_words_for_any_window(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", "  ", "a", "A b", " x\ty\nz  \r", "é à B", "q" * 500 + " b c d"]
    texts += [" ".join(rng.choices(["ab", "Ab", "c", "É", "xyz" * 5], k=rng.randrange(40))) for _ in range(100)]
    for window in (1 << 20, 64, 7):
        monkeypatch.setattr(shingles, "WINDOW", window)
        for words in (1, 3, 5):
            got = list(shingles.shingle_sets(pa.array(texts), words))
            want = [shingle_set(t, words) for t in texts]
            assert [len(g) for g in got] == [len(w) for w in want]
            for _ in range(300):
                i, j = rng.randrange(len(texts)), rng.randrange(len(texts))
                assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_components_of_paths_stars_and_single_edges(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, **{100 + i: 100 for i in range(1, 30)}, 300: 200}
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_boundary_follows_cost(spark):
    """Prefixes of two and of 41 shingles: pairs of the former pay once most postings are shared."""
    rows = [(n, list(range(12))) for n in [10] * 50 + [400] * 50]
    classes = spark.createDataFrame(rows, "n int, prefix array<long>")
    lists = lambda size: spark.createDataFrame([(1, size)], "key long, len long")
    assert ngram_join.boundary(classes, lists(2), 90) < 10
    assert 10 <= ngram_join.boundary(classes, lists(2150), 90) < 400
    assert ngram_join.boundary(classes.limit(0), lists(2), 90) == 0


def test_words_that_equal_sums_of_powers_confuse_are_told_apart():
    """The Thue-Morse word over a and b and its complement, for any odd base."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    hashes, _ = shingles.word_hashes(pa.array([word, other, "A" + word[1:]]))
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]


def test_pairs_of_a_shared_passage_grow_with_its_documents(spark):
    """Documents that share a passage and nothing else leave no pairs to be checked."""
    passage = " ".join(f"p{i}" for i in range(60))
    counts = []
    for size in (40, 160):
        texts = [passage + " " + " ".join(f"d{d}w{i}" for i in range(60)) for d in range(size)]
        rows = ngram_join._rows(documents(spark, texts), "doc_id", "text")
        levels = ngram_join.shared_rarity(rows, 5)
        classes = ngram_join.classes_of(ngram_join.signatures(rows, 5, 80, levels))
        postings = ngram_join.candidates(classes, 80)
        none = spark.createDataFrame([], "node long, root long")
        tested = spark.createDataFrame([], "a long, b long")
        counts.append(ngram_join.open_pairs(postings, classes, none, tested, 80).count())
    assert counts[1] <= 4 * counts[0] + 16
