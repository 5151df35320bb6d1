"""The stages in turn, each judged on its own input."""

import corpus_pipeline
from driftline.llm.common import materialise


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialise(stage(spark, docs, sf_dir), name)
        assert kept.columns == columns and 0 < kept.count()
        if name in ("toxicity", "exact_dedup", "near_dedup"):
            assert kept.join(docs, "doc_id", "left_anti").count() == 0 and kept.count() <= docs.count()
            assert kept.count() == kept.select("doc_id").distinct().count()
        docs = kept
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
