import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sievestream.llm import queries

SMALL = "/root/testdata/sf0.001"


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(q.split("_")[0][2:]) for q in queries.QUERIES) == list(range(1, 14))


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not here")
def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.cut_lineage(stage(spark, docs, SMALL), "test")
        assert docs.columns == before.columns, name
        assert docs.select("doc_id").subtract(before.select("doc_id")).isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select("doc_id", "start", "ids_crc32").collect())) == sorted(map(tuple, packed.select("doc_id", "start", "ids_crc32").collect()))
