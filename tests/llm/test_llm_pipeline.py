"""The pipeline's stages on a small table."""

from __future__ import annotations

import corpus_pipeline


def test_stages_keep_the_columns_and_take_effect(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), "stage")
        assert set(corpus_pipeline.COLUMNS) <= set(docs.columns)
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] and counts[4] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(packed.columns)
    assert packed.where("piece = 0").count() == counts[4]
