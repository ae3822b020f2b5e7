"""The pipeline's stages on the smallest table."""

from __future__ import annotations

import corpus_pipeline
from sheafwork.llm.jobs import documents, stage


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = documents(spark, sf_dir)
    columns, counts = docs.columns, [docs.count()]
    for name, fn in corpus_pipeline.STAGES:
        docs = stage(fn(spark, docs, sf_dir), name)
        counts.append(docs.count())
        if name != "pack":
            assert docs.columns == columns
    kept, deduped, mixed = counts[1], counts[3], counts[4]
    assert kept == counts[0] == counts[2] and deduped == 187 and mixed > deduped
    assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_unlabelled_documents_stay(spark):
    schema = "doc_id long, text string, lang string, source string"
    texts = ["a clean text", "é", "12 3", "", None, "日本"]
    docs = spark.createDataFrame([(i, t, None, "a") for i, t in enumerate(texts)], schema)
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 5]
