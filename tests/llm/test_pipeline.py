import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402


def test_stages(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, n = docs.columns, docs.count()
    counts = [n]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert n > counts[1] > counts[2] == counts[3] > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert pieces.agg({"length": "sum"}).first()[0] > 0


def test_empty(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        assert docs.count() == 0
