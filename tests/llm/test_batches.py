import pyarrow as pa
import pytest

from lotwise.llm import batches, ngram_join, packing

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_small_batches_hold_within_and_not_behind(spark):
    def sizes(given):
        for batch in given:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    before = spark.conf.get(ROWS)
    with batches.small_batches(spark):
        found = [r["n"] for r in spark.range(0, 4500, 1, 1).mapInArrow(sizes, "n long").collect()]
    assert sum(found) == 4500 and max(found) <= batches.BATCH_ROWS
    with pytest.raises(ZeroDivisionError), batches.small_batches(spark):
        1 / 0
    assert spark.conf.get(ROWS) == before


def test_a_smaller_bound_of_the_session_stays(spark):
    before = spark.conf.get(ROWS)
    spark.conf.set(ROWS, 7)
    try:
        with batches.small_batches(spark):
            assert spark.conf.get(ROWS) == "7"
        assert spark.conf.get(ROWS) == "7"
    finally:
        spark.conf.set(ROWS, before)


def test_texts_are_handed_over_in_small_batches(spark, monkeypatch):
    """Where the join and the packing give texts to Python."""
    docs = spark.range(5).selectExpr("id AS doc_id", "concat('a b c ', id % 2) AS text")
    seen = []
    for module, names in ((ngram_join, ("signatures", "links")), (packing, ("pieces",))):
        def staged(df, name, own=module.stage):
            seen.append((name, int(spark.conf.get(ROWS))))
            return own(df, name)

        monkeypatch.setattr(module, "stage", staged)
        frame = ngram_join.near_duplicates(docs, percent=30) if module is ngram_join else packing.pack_documents(docs)
        assert frame.count() == 5
        assert {n for name, n in seen if name in names} == {batches.BATCH_ROWS}
