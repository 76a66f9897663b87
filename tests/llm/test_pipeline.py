from collections import Counter, defaultdict

import corpus_pipeline
from corpus import SF_DIR, documents
from pyspark.sql import functions as F
from test_ngram_join import brute_force

from lotwise.llm import language_id, packing


def test_stages_and_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "n-gram Jaccard join", "best-fit packing",
    ]


def test_whole_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = language_id.model_of(docs)
    judged = language_id.identify(docs, model).filter(~F.col("rejected"))
    known = {r["doc_id"] for r in judged.collect()}
    assert len(known) > 0.99 * len(texts)

    largest = {}
    for i in sorted(known):
        largest[texts[i]] = i
    distinct = {i: texts[i] for i in largest.values()}
    groups = defaultdict(list)
    for i, (n, component) in brute_force(distinct, 5, 80).items():
        groups[component if n else ("empty", i)].append(i)
    kept = {min(g): texts[min(g)] for g in groups.values()}

    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    want = packing.pack_documents(documents(spark, []).union(spark.createDataFrame(list(kept.items()), "doc_id long, text string")))
    piece = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert Counter(map(piece, rows)) == Counter(map(piece, want.collect()))


def test_each_stage_keeps_columns_and_handles_odd_rows(spark):
    text = "the words of this are in the language that it was learned from"
    rows = [(i, f"{text} number {chr(97 + i)} and more of it", "en", "s", 5) for i in range(6)]
    rows += [(10, None, None, None, None), (11, "", "en", None, 0), (12, "12 34", None, "s", 5), (None, text, None, None, 1)]
    rows += [rows[0], rows[0], (20, text + " x" * 30000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({"keep_id": F.lit(1), "kept": F.lit("x"), "_text": F.lit(2), "score": F.lit("y")})
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, SF_DIR).columns == docs.columns
            stage(spark, frame, SF_DIR).collect()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF_DIR).count() >= 0
    language, exact, near, _ = (f for _, f in corpus_pipeline.STAGES)
    ids = lambda df: sorted(r["doc_id"] or 0 for r in df.collect())
    assert ids(language(spark, docs, SF_DIR)) == [0, 0, 0, 0, 1, 2, 3, 4, 5, 20]
    assert ids(exact(spark, docs, SF_DIR)) == [0, 0, 1, 2, 3, 4, 5, 11, 12, 20]
    assert len(ids(near(spark, docs, SF_DIR))) <= len(rows) - 2
