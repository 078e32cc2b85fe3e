"""The pipeline's stages, each on its predecessor's rows."""

import __spark_entry__ as driver
import corpus_pipeline
from feedloom.llm import simhash
from feedloom.llm.queries import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = docs, stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        rows = kept.collect()
        ids = {r.doc_id for r in rows}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name != "mixing":
            assert len(rows) == len(ids)
        if name == "simhash":
            groups = {r.component_id for r in simhash.components(before).collect()}
            assert ids == groups
        docs = spark.createDataFrame(rows, docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_run_equals_stages(spark):
    got = driver.queries()["pipeline"](spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = got.orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
