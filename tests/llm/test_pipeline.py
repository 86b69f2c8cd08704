"""The corpus pipeline, stage by stage, against its operators."""

import corpus_pipeline
from tests.conftest import SF_SMALL


def test_stages_chain_and_decide(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, SF_SMALL), name)
        assert docs.columns == columns
        after = docs.count()
        assert 0 < after <= before and (name != "secret_scans" or after == before)
        before = after
    ids = {r[0] for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in packed} == ids and len(ids) == before


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false")
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, SF_SMALL).count() == 0
