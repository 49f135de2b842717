"""The pipeline keeps clean documents and drops planted ones; its queries are registered."""

import hashlib

import corpus_pipeline
from pyspark.sql import functions as F

from gridspark.llm import bpe, decontaminate, jaccard
from gridspark.llm._text import parquet
from gridspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)} and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5


def test_last_stage_decodes(spark, make_docs, monkeypatch):
    texts = ["one text", "é 水 \x00 x", "", None]
    docs = make_docs(list(enumerate(texts)))
    got = {r["doc_id"]: r for r in corpus_pipeline.encode(spark, docs, SF).collect()}
    for i, text in enumerate(texts):
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest() and got[i]["round_trips"]
    trip = bpe.round_trip
    monkeypatch.setattr(bpe, "round_trip", lambda *a, **b: trip(*a, **b).withColumn("decoded", F.lit(b"other")))
    assert not any(r["round_trips"] for r in corpus_pipeline.encode(spark, docs, SF).collect())


def test_stages(spark):
    docs = parquet(spark, SF, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.count()
        kept = spark.createDataFrame(stage(spark, kept, SF).toPandas(), docs.schema)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes and 0 < kept.count() <= before, name
    assert jaccard.join(kept).where("n_links > 0").count() == 0
    assert decontaminate.find(kept, parquet(spark, SF, "benchmark")).count() == 0
    out = corpus_pipeline.run(spark, SF)
    assert out.count() == kept.count() and out.where("n_tokens <> size(token_ids)").count() == 0
