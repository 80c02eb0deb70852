"""The stages of the corpus pipeline, one after the other and on odd rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from test_operators import DOCS, SF_DIR, docs_of

import corpus_pipeline


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    count = docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        following = function(spark, docs, SF_DIR)
        assert following.columns == docs.columns, name
        assert following.count() <= count
        docs, count = following, following.count()
    pieces = corpus_pipeline.run(spark, SF_DIR)
    assert pieces.agg(F.count_distinct("doc_id")).first()[0] == count


def test_one_document_of_each_group_stays(spark):
    texts = ["a b c d e f g"] * 3 + ["other words stand in this one", None, ""]
    docs = docs_of(spark, texts)
    frame = docs.unionByName(docs.where("doc_id = 0")).unionByName(
        docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long"))
    )
    kept = corpus_pipeline.drop_near_copies(spark, frame, SF_DIR)
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 0), (True, 0), (True, 3), (True, 4),
    ]


def test_texts_of_one_id_are_judged_in_their_own_groups(spark):
    """A is in documents 2 and 3, B in 1 and 2, and C, D and D again under one id."""
    a, b = "alpha beta gamma delta epsilon zeta eta", "one two three four five six seven eight"
    c, d = "red green blue white black brown pink", "north south east west up down left right"
    texts = [(1, b), (2, a), (2, b), (3, a), (7, c), (7, d), (7, d), (8, d), (9, c)]
    rows = [(k, t, "en", "s", len(t), "x", 1, 2) for k, t in texts]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, DOCS), SF_DIR)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, b), (2, a), (7, c), (7, d)])


def test_odd_rows_go_through_all_stages(spark):
    """Null and very long texts, rows without id, and columns named like the operators' own."""
    long = " ".join(f"word{k % 977} of{k}" for k in range(60_000))
    rows = [(1, None), (2, long), (3, long), (None, "no id here"), (5, ""), (5, "short text of five words")]
    frame = spark.createDataFrame(
        [(k, t, "en", "s", 1, 1, 1, "x", 1, "y", True, "z") for k, t in rows],
        "doc_id long, text string, lang string, source string, n_chars int, sign int, `row` int, _key string,"
        " _text int, ids string, leads boolean, component_id string",
    )
    docs = frame
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, SF_DIR)
        assert docs.columns == frame.columns
        docs.count()
    pieces = corpus_pipeline.pack_sequences(spark, docs, SF_DIR)
    assert pieces.count() >= docs.count()


def test_empty_documents_go_through(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF_DIR)
    assert docs.count() == 0
