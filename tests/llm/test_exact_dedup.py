import os

from compare import canonical, duck_rows, spark_rows
from corpus import SF_DIR, documents, duck
from pyspark.sql import functions as F

from lotwise.llm import exact_dedup
from lotwise.llm.exact_dedup import deduplicate, keep_distinct
from lotwise.sources.staging import stage

ROWS = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (None, "a"), (4, None), (5, ""), (3, "zz"), (6, "a ")]
WANTED = sorted(
    [(1, 2, 4, False), (2, 2, 4, False), (2, 2, 4, True), (0, 2, 4, False), (3, 3, 1, True)]
    + [(4, 5, 2, False), (5, 5, 2, True), (3, 3, 1, True), (6, 6, 1, True)]
)


def rows_of(df):
    return sorted((r["doc_id"] or 0, r["keep_id"], r["group_size"], r["kept"]) for r in df.collect())


def test_query_equals_sql(spark):
    got = canonical(*spark_rows(exact_dedup.query(spark, SF_DIR)))
    assert got == canonical(*duck_rows(duck(), exact_dedup.ORACLE))


def test_nulls_ties_and_repeated_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert rows_of(deduplicate(docs)) == WANTED


def test_state_carries_over_micro_batches_and_bytes_decide(spark):
    """A digest that collides, read one file at a time."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(6)
    by_length = lambda text: F.length(F.coalesce(text, F.lit(""))).cast("string")
    assert rows_of(deduplicate(docs, digest=by_length, batch_bytes=1)) == WANTED


def test_a_small_ledger_is_one_micro_batch(spark, monkeypatch):
    """Each micro-batch opens all stores anew; a ledger with enough bytes still takes several."""
    paths = {}

    def path_of(spark, name, own=exact_dedup.staged_path):
        return paths.setdefault(name, own(spark, name))

    monkeypatch.setattr(exact_dedup, "staged_path", path_of)
    texts = spark.range(40000).select(F.col("id").alias("doc_id"), F.md5(F.col("id").cast("string")).alias("text"))
    docs = stage(texts.repartition(16), "many-files")
    found = []
    for least in (exact_dedup.LEAST_BYTES, 1):
        monkeypatch.setattr(exact_dedup, "LEAST_BYTES", least)
        assert deduplicate(docs).filter("kept").count() == 40000
        found.append(len([x for x in os.listdir(f"{paths['dedup-state']}/commits") if x.isdigit()]))
        paths.clear()
    assert found[0] == 1 and found[1] >= 2


def test_kept_rows_have_the_columns_of_the_input(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    docs = docs.withColumns({"keep_id": F.lit("x"), "_digest": F.lit(1), "kept": F.lit(None).cast("int")})
    got = keep_distinct(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [
        (2, "a"), (3, "b"), (3, "zz"), (5, ""), (6, "a "),
    ]


def test_empty_table_and_long_text(spark):
    assert deduplicate(documents(spark, ["x"]).limit(0)).collect() == []
    long = "word " * 200_000
    assert rows_of(deduplicate(documents(spark, [long, long, long + "x"]))) == [
        (0, 1, 2, False), (1, 1, 2, True), (2, 2, 1, True),
    ]


def derived(spark, tmp_path):
    """Frames in which rows of a file occur more than once."""
    path = str(tmp_path / "docs")
    spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b"])], "doc_id long, texts array<string>").write.parquet(path)
    rows = spark.read.parquet(path)
    exploded = rows.select("doc_id", F.explode("texts").alias("text"))
    stored = exploded.filter("doc_id = 1")
    twice = spark.createDataFrame([(0,), (1,)], "n int")
    yield exploded, 2
    yield stored.unionByName(stored), 2
    yield rows.select("doc_id", F.col("texts")[0].alias("text")).crossJoin(twice), 2
    yield rows.select("doc_id", F.col("texts")[0].alias("text")).filter("doc_id > 0"), 2


def test_rows_of_derived_frames_are_told_apart(spark, tmp_path):
    for docs, kept in derived(spark, tmp_path):
        rows = deduplicate(docs).collect()
        assert len(rows) == docs.count()
        assert sum(r["kept"] for r in rows) == kept
        assert keep_distinct(docs).count() == kept
