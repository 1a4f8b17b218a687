"""The pipeline's stages on the small table: what each keeps, changes and returns."""

import re

import corpus_pipeline
from tidemark.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held, out = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, out, SF))
        held[name] = out
        if name != "packing":
            assert out.columns == docs.columns
    good = {r["doc_id"] for r in held["quality"].collect()}
    assert sum(labels[i] == (i in good) for i in labels) >= 0.9 * len(labels)
    kept = {r["doc_id"] for r in held["near_duplicates"].collect()}
    assert kept < good
    secrets = held["secrets"].collect()
    assert {r["doc_id"] for r in secrets} == kept
    assert not any(re.search(r"[0-9a-f]{32}", r["text"]) for r in secrets)
    assert {r["doc_id"] for r in held["mixing"].collect()} <= kept
    packed = held["packing"].collect()
    assert sum(r["piece"] == 0 for r in packed) == held["mixing"].count()
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed)
