"""The registered queries: each applies one operator, with production parameters, to its whole
table and derives the columns that its contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (bpe, exact_dedup, graph_dedup, hard_negatives, jaccard, lm, merkle, packing, pieces,
               quality, sharding, toxicity, warc)
from .common import table
from .oracle import ORACLE  # noqa: F401  (registered beside the queries)


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_graph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"),
                       tokenizer_file("byte_bpe_50k.tiktoken"), pattern())


def op4_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"), scratch_path(spark, "llm-warc"),
                                 min_bytes=0)


def op6_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.dedup(table(spark, sf_dir, "documents"),
                            locator=F.col("_metadata.file_path"))
    return out.withColumnRenamed("digest", "text_sha256")


def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  tokenizer_file("byte_bpe_50k.json"), pattern(), size=2048)


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove_documents(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label=moved)


def op13_score_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_pu_quality, op2_graph_dedup, op3_bpe, op4_log_bilinear, op5_warc_index, op6_toxicity_fm, op7_rendezvous, op8_exact_dedup, op9_best_fit,
    op10_ngram_jaccard, op11_merkle_manifest, op12_hard_negatives, op13_score_agenda)}
