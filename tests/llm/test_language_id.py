import pytest
from corpus import SF_DIR, documents
from pyspark.sql import functions as F

from lotwise.llm import language_id
from lotwise.llm.language_id import identify, learn, model_of


@pytest.fixture(scope="module")
def model(spark):
    return model_of(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    fold = docs.filter(language_id.held_out(F.col("doc_id")))
    right = F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))
    rejected = F.avg(F.col("rejected").cast("int"))
    accuracy, lost = identify(fold, model).agg(right, rejected).first()
    assert accuracy > 0.99 and lost < 0.01


def test_query_reads_every_row_and_only_learned_languages(spark):
    rows = language_id.query(spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.collect())
    assert {r["lang_pred"] for r in rows} <= {"en", "de", "fr", "es", "und"}
    assert all(0 <= r["score"] <= 1 for r in rows)
    folds = {r["doc_id"]: r["held_out"] for r in rows}
    import zlib

    assert all(folds[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in folds)


def test_texts_without_letters_are_undetermined(spark, model):
    docs = documents(spark, [None, "", " \n", "123 !? _ ²", "é", "The other thing, and that was it."])
    got = {r["doc_id"]: r for r in identify(docs, model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["rejected"] and got[i]["score"] == 0 for i in range(4))
    assert got[4]["lang_pred"] != "und"
    assert (got[5]["lang_pred"], got[5]["rejected"]) == ("en", False)


def test_all_of_a_long_text_counts(spark, model):
    sample = {r["lang"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
              .filter("length(text) > 3000 and length(text) < 4000").orderBy("doc_id").collect()}
    mostly_french = sample["en"][:600] + (sample["fr"][:3000] + " ") * 40
    got = identify(documents(spark, [mostly_french, sample["en"][:600]]), model)
    assert [r["lang_pred"] for r in got.orderBy("doc_id").collect()] == ["fr", "en"]


def test_narrow_margins_are_rejected(spark, model):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for r in identify(docs, model, narrow=0.05).collect():
        assert r["rejected"] == (r["lang_pred"] == "und" or r["score"] < 0.05)


def test_nothing_learned_one_language_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text", None, 7)] * 2, "doc_id long, text string, lang string, score int")
    assert learn(docs) == {} and learn(docs.limit(0)) == {}
    got = identify(docs, {})
    assert got.columns == ["doc_id", "text", "lang", "score", "lang_pred", "rejected"]
    assert [(r["lang_pred"], r["score"], r["rejected"]) for r in got.collect()] == [("und", 0.0, True)] * 2
    one = learn(docs.withColumn("lang", F.lit("xx")))
    assert [(r["lang_pred"], r["score"]) for r in identify(docs, one).collect()] == [("xx", 1.0)] * 2
    assert identify(docs.limit(0), one).collect() == []


def test_what_is_learned_is_bounded(spark, model):
    most = language_id.SAMPLE_ROWS * (language_id.SAMPLE_CHARS + 1) * 4
    assert sorted(model) == ["de", "en", "es", "fr"] and all(0 < len(c) <= most for c in model.values())
