import hashlib
import random
import re

import pytest
from compare import canonical, duck_rows, spark_rows
from corpus import SF_DIR, documents, duck
from pyspark.sql import functions as F

from lotwise.llm import fill_in_middle
from lotwise.llm.fill_in_middle import (
    SENTINEL_BYTES,
    SENTINELS,
    TEXT,
    Piece,
    arranged,
    cut,
    parted,
    restore_documents,
    restored,
    spans,
)

TEXTS = [
    "one\ntwo\nthree", "a\n\n\nb\n", "\n", "", None, "no line end", "has <S> in it\nx\n", "é\nü\n字\n" * 40,
    "ends with <\n<", "x\r\ny\rz\n", "<M\n<S", "word " * 300_000 + "\n" + "line\n" * 200_000,
]


def plain_version(name, text, rate=100, spm_rate=50):
    """Form, prefix, middle and output of one document, by slicing its lines."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexed = hashlib.sha256(f"7:{'' if name is None else name}".encode()).hexdigest()
    h = [int(hexed[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    pre, mid, suf = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_query_equals_sql(spark):
    got = canonical(*spark_rows(fill_in_middle.query(spark, SF_DIR)))
    assert got == canonical(*duck_rows(duck(), fill_in_middle.ORACLE))


@pytest.mark.parametrize("rate, spm_rate", [(100, 50), (60, 20), (0, 50)])
def test_odd_texts(spark, rate, spm_rate):
    texts = TEXTS * 4
    made = fill_in_middle.fill_in_middle(documents(spark, texts), rate=rate, spm_rate=spm_rate)
    rows = restore_documents(made.withColumn("again", F.col("output"))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        wanted = plain_version(r["doc_id"], text, rate, spm_rate)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["again"]) == wanted
        assert r["output_sha256"] == hashlib.sha256(wanted[-1].encode()).hexdigest()
        assert r["restored"] == text
        assert r["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        buffers = (memoryview(text.encode()), memoryview(SENTINEL_BYTES))
        table = [Piece(*p) for p in r["pieces"]]
        assert b"".join(spans(table, buffers)).decode() == wanted[-1]
    if rate:
        assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_cutting_splits_descriptors_of_any_table():
    draw = random.Random(3)
    buffers = (memoryview(b"abcdefghij" * 5), memoryview(b"0123456789"))
    for _ in range(300):
        table = []
        for _ in range(draw.randrange(5)):
            buffer = draw.choice((TEXT, SENTINELS))
            start = draw.randrange(len(buffers[buffer]))
            table.append(Piece(buffer, start, draw.randrange(len(buffers[buffer]) - start + 1)))
        whole = b"".join(spans(table, buffers))
        at = sorted(draw.randrange(len(whole) + 1) for _ in range(2))
        before, behind = cut(table, at[0])
        assert b"".join(spans(before, buffers)) == whole[: at[0]]
        assert b"".join(spans(behind, buffers)) == whole[at[0] :]
        parts = parted(table, *at)
        for form, order in fill_in_middle.ORDERS.items():
            assert restored([parts[p] for p in order], form) == [p for part in parts for p in part]
            assert sum(p.length for p in arranged(parts, form)) == len(whole) + 9


def test_nulls_repeated_rows_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(None, "a\nb\n", "q"), (3, "a\nb\n", None), (3, "a\nb\n", None)], "doc_id long, text string, output string"
    ).withColumns({"form": F.lit(1), "Restored": F.lit(2.5), "_id": F.lit("z")})
    made = fill_in_middle.fill_in_middle(docs)
    rows = made.collect()
    assert sorted((r["doc_id"] or 0, r["output"]) for r in rows) == sorted(
        (i or 0, plain_version(i, "a\nb\n")[-1]) for i in (None, 3, 3)
    )
    back = restore_documents(made.withColumn("Restored", F.lit(1)))
    assert back.columns.count("restored") == 1 and "Restored" not in back.columns
    assert {r["restored"] for r in back.collect()} == {"a\nb\n"}
    assert fill_in_middle.fill_in_middle(docs.limit(0)).collect() == []
    assert restore_documents(made.limit(0)).collect() == []


def test_an_output_that_is_not_of_its_form_is_an_error(spark):
    rows = spark.createDataFrame([("x<P>a<S>b<M>c", "psm")], "output string, form string")
    with pytest.raises(Exception, match="no output of the form psm"):
        restore_documents(rows).collect()
