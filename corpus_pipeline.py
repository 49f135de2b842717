"""From raw documents to token ids: toxic texts go, one of each group of near copies stays, long repeats are cut out, benchmark
leaks go, and what remains is encoded, decoded again and compared with the text. Each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import bpe, decontaminate, jaccard, suffix, toxicity
from gridspark.llm._text import parquet
from gridspark.session import materialize

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model, thresholds = toxicity.fit_on(docs, parquet(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model, thresholds=thresholds)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, n=5, threshold=0.8)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(docs, length=100)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, parquet(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    given = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("text_sha256")
    decoded = F.sha2(F.col("decoded"), 256)
    return (bpe.round_trip(docs.select("doc_id", "lang", "source", "text", given), RANKS, PATTERN,
                           keep=("doc_id", "lang", "source", "text_sha256"))
            .select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                    decoded.alias("decoded_sha256"), (decoded == F.col("text_sha256")).alias("round_trips")))


STAGES = [("toxicity", drop_toxic), ("n-gram Jaccard join", drop_near_copies), ("suffix-array dedup", cut_repeats),
          ("benchmark decontamination", drop_leaks), ("byte-level BPE", encode)]

#: Training, MinHash and alignment have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
