"""The corpus pipeline: raw documents to packed training sequences in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents`` and decide only which rows stay:

1. toxicity: rows that the factorization machine scores 0.7 or more go;
2. quality: rows that the positive-unlabelled classifier scores below 0.5 go;
3. exact dedup: of equal texts the row with the largest doc_id stays;
4. n-gram join: of documents linked by five-word shingles at a similarity of 0.8 or more (and by
   chains of such links) the one with the smallest doc_id stays; documents without words, which
   link with nothing, stay;
5. packing: the kept documents as pieces of 2048-token sequences.

The quality stage keeps what looks like the trusted positives: null, empty and blank texts, one
character or word repeated, and texts of a few words or letters score near 0 and go there, so it may
keep nothing of an input that holds no prose. Every other stage keeps such rows. Otherwise null, empty
and very long texts pass through every stage as their operators define; extra columns
of the input are kept through stage 4. Rows that repeat a doc_id share its decision in stage 4,
and in stage 3 those with the kept text all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.llm import exact_dedup, jaccard, packing, quality, toxicity
from finmart.llm.common import land, table, text_or_empty
from finmart.llm.queries import pattern, tokenizer_file

TOXIC_FROM, GOOD_FROM = 0.7, 0.5
#: Chunks that a worker of the last stage remembers: fewer than op9 alone takes, because by then the
#: executors' heaps hold what four stages left.
CACHE_ENTRIES = 200_000


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, fitted on the labelled training rows, scores below 0.7."""
    machine = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.filter(machine.score(F.col("text").cast("string")) < TOXIC_FROM)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model scores 0.5 or more. It learns from the whole table, so
    that what the first stage removed does not change it."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.filter(model.score(F.col("text").cast("string")) >= GOOD_FROM)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row (the largest doc_id) of each group of equal texts."""
    out = exact_dedup.dedup(docs, locator=F.col("_metadata.file_path"))
    goes = land(out.filter("not kept").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct(), "copies")
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (
        F.sha2(text_or_empty("text"), 256) == F.col("__digest"))
    return docs.join(goes, same, "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row (the smallest doc_id) of each component of near copies."""
    out = land(jaccard.near_components(docs, n=5, percent=80), "near")
    goes = out.filter("component_id is not null and doc_id <> component_id") \
        .select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(goes, docs["doc_id"] == F.col("__id"), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents with their places in 2048-token sequences."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), pattern(), size=2048,
                                  cache_entries=CACHE_ENTRIES)


STAGES = [("toxicity", remove_toxic), ("quality", keep_good), ("exact_dedup", drop_copies),
          ("ngram_jaccard", drop_near_copies), ("packing", pack)]

#: The classifiers are fitted, and tokenizers are no SQL: tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each stage's rows are landed before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
