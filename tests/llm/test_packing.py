import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpus import SF_DIR, documents
from tokenizers import Tokenizer

from lotwise.llm.packing import cut, encoder, pack_documents, sum_of_squares

ODD = [
    None, "", "a  b   c\n\n d \n e\t\tf ", "x<|endoftext|>y <|endoftext|> z", " lead", "  lead two",
    "it's we're x   y\x1c z", "a" * 5000, " \n", "日本語 テキスト 123 ½ ²", "end \n", "word " * 3000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts, tokenizer, capacity=2048):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        ids = tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [0]
        own.sort(key=lambda r: r["piece"])
        at = 0
        for n, r in enumerate(own):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, at, zlib.crc32(part))
            assert r["length"] == capacity or n == 0
            at += r["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    return len(sequences), -(-total // capacity)


def test_whole_documents_against_the_tokenizer(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    used, least = check(pack_documents(docs).collect(), texts, tokenizer)
    assert used <= least * 1.01 + 1


def test_odd_texts_give_the_ids_of_the_tokenizer(spark, tokenizer):
    check(pack_documents(documents(spark, ODD)).collect(), dict(enumerate(ODD)), tokenizer)


@pytest.mark.parametrize("text", [" " * 2_000_000 + "a", "b" + "\n" * 2_000_000, "c d" + " \t" * 1_000_000 + "e f", "g h" + "\n" * 2_000_000 + "i j"])
def test_long_white_space_gives_the_ids_of_the_tokenizer(tokenizer, text):
    own = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert own.ids(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_cut():
    parts = [(s, len(p) // 4) for s, p in cut(b"\0" * 4 * 9, 4)]
    assert parts == [(0, 1), (1, 4), (5, 4)]
    assert [(s, len(p) // 4) for s, p in cut(b"\0" * 16, 4)] == [(0, 4)]


def brute_force(lengths, capacity):
    """Sum of squares by its definition, over all open sequences that have room."""
    used, out = [], []

    def squares(levels):
        counts = defaultdict(int)
        for u in levels:
            if u < capacity:
                counts[capacity - u] += 1
        return sum(c * c for c in counts.values())

    for size in lengths:
        fitting = [i for i, u in enumerate(used) if u + size <= capacity and u < capacity]
        if fitting:
            after = lambda i: squares(used[:i] + [used[i] + size] + used[i + 1 :])
            best = min(fitting, key=lambda i: (after(i), capacity - used[i]))
            out.append((capacity - used[best], after(best)))
            used[best] += size
        else:
            used.append(size)
            out.append((capacity, squares(used)))
    return out, used


def test_sum_of_squares_against_its_definition():
    rng = np.random.default_rng(5)
    for _ in range(30):
        lengths = rng.integers(1, 21, 40)
        sequence, offset = sum_of_squares(lengths, 20)
        want, used = brute_force(lengths.tolist(), 20)
        assert [20 - o for o in offset] == [gap for gap, _ in want]
        assert sorted(np.bincount(sequence, lengths).astype(int).tolist()) == sorted(used)


def test_repeated_rows_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 5)] * 3 + [(None, "c", 6)], "doc_id long, text string, piece int")
    rows = pack_documents(docs, capacity=4).collect()
    assert sorted(r["length"] for r in rows) == [2, 3, 3, 3]
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 4
    assert pack_documents(docs.limit(0)).collect() == []
