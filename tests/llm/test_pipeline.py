"""The pipeline on a small table, and its queries' registration."""

import re

import __spark_entry__ as entry_point
import corpus_pipeline
from ratelake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry_point.queries())
    for n in range(1, 11):
        assert [q for q in names if re.match(rf"op{n}_", q)]
    assert "pipeline" in names and set(ORACLES) <= set(QUERIES) <= names


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "quality":
            kept = {r["doc_id"] for r in docs.collect()}
            wrong = [i for i, q in labels.items() if i in before and (i in kept) != (q == 1)]
            assert len(wrong) <= 0.05 * len(labels)
        if name == "repeats":
            assert all(len(r["text"]) <= len(before[r["doc_id"]]) for r in docs.collect())
    assert 0 < docs.count() < len(before)


def test_empty_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
