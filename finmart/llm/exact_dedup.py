"""Exact deduplication as a stateful stream over content fingerprints.

A fingerprint row is (digest, id, locator): the SHA-256 of the whole text, the stable document id
and where the bytes are. A Structured Streaming aggregation keeps, for every digest ever seen,
the largest id, its locator and the number of rows, in a disk-backed (RocksDB) state store and
without a watermark, so nothing expires. Partial aggregation runs before the shuffle: a text that
makes up a third of all rows reaches its state partition as one row a task. Texts never enter the
stream or its state. On a hit (a digest seen more than once) the full bytes of
its rows are read where the locators point and compared; rows whose digest matches but whose bytes differ are grouped again by their
whole text, so a collision loses nothing.

A null text counts as empty. Repeated ids are rows of their own: a group's ``keep_id`` is its
largest id and every row with that id is kept. Rows without an id sort below all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import land, maybe_in, text_or_empty

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Settings of the stream's state stores. A store reserves some MB of disk for its logs ahead of
#: use unless told otherwise, and there is one for each shuffle partition.
_STATE = {_PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
          "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Column | None = None, locator: Column | None = None) -> DataFrame:
    """(digest, id, locator) for a batch or streaming frame of documents. For frames read from
    files the locator is best ``F.col("_metadata.file_path")``; together with the id it names
    the row that holds the bytes."""
    digest = F.sha2(text_or_empty(text_col), 256) if digest is None else digest
    return docs.select(digest.alias("digest"), F.col(id_col).alias("id"),
                       (F.lit("") if locator is None else locator).alias("locator"))


def dedup_stream(prints: DataFrame, out: str, checkpoint: str, trigger: dict | None = None):
    """Start the stateful query: every micro-batch appends the state rows that it changed
    (digest, keep_id, locator, group_size) to ``out``, under its batch number, so that a batch
    that is run again after a failure replaces its own rows."""
    spark = prints.sparkSession
    state = prints.groupBy("digest").agg(
        F.max(F.struct(F.col("id"), F.col("locator"))).alias("last"),
        F.count(F.lit(1)).alias("group_size"))
    changed = state.select("digest", F.col("last.id").alias("keep_id"),
                           F.col("last.locator").alias("locator"), "group_size")

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)   # taken over by the query when it starts
    try:
        return (changed.writeStream.outputMode("update").foreachBatch(write)
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The newest state row of every digest: (digest, keep_id, locator, group_size)."""
    rows = spark.read.option("basePath", out).parquet(out)
    return rows.groupBy("digest").agg(
        F.max_by(F.struct("keep_id", "locator", "group_size"), "batch").alias("s")) \
        .select("digest", "s.*")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          digest: Column | None = None, locator: Column | None = None,
          files_per_batch: int = 1000) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    The fingerprints of a batch frame are landed and replayed through the stream, so the same
    state logic serves a table and a live feed. ``digest`` may replace SHA-256; a weak one only
    makes more byte comparisons.
    """
    spark = docs.sparkSession
    digest = F.sha2(text_or_empty(text_col), 256) if digest is None else digest
    prints = fingerprints(docs, id_col, text_col, digest, locator)
    feed, out = scratch_path(spark, "llm-feed"), scratch_path(spark, "llm-state-rows")
    prints.write.parquet(feed)
    stream = (spark.readStream.schema(prints.schema)
              .option("maxFilesPerTrigger", files_per_batch).parquet(feed))
    dedup_stream(stream, out, scratch_path(spark, "llm-state")).awaitTermination()
    rows = spark.read.schema(prints.schema).parquet(feed)
    if not _written(spark, out):   # an empty input makes no batch
        return rows.select(F.col("id").alias("doc_id"), F.col("id").alias("keep_id"),
                           F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
                           "digest")
    groups = land(latest(spark, out), "groups")
    texts = docs.select(F.col(id_col).alias("id"), digest.alias("digest"),
                        text_or_empty(text_col).alias("text"))
    odd = land(_unequal(texts, groups.filter("group_size > 1")), "collisions")
    placed = rows.drop("locator").join(groups.drop("locator"), "digest")
    if not odd.isEmpty():
        placed = _regroup(texts, placed, odd)
    return placed.select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                         F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def _written(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _unequal(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """Digests whose rows do not all have the same bytes.

    Only rows whose digest has a hit (and a few that a key filter lets through) carry their text
    here. The smallest and the largest text of a digest are equal just when all are; both are
    reduced in each task before the shuffle, so a very large group is no large partition.
    """
    suspects = texts.filter(maybe_in(hits, "digest")(F.col("digest")))
    return (suspects.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("most"))
            .filter("least <> most").select("digest"))


def _regroup(texts: DataFrame, placed: DataFrame, odd: DataFrame) -> DataFrame:
    """Exact groups for the digests in ``odd``: by the whole text itself."""
    odd_texts = texts.join(odd, "digest", "left_semi")
    exact = odd_texts.groupBy("digest", "text").agg(F.max("id").alias("keep_id"),
                                                    F.count(F.lit(1)).alias("group_size"))
    columns = ["digest", "id", "keep_id", "group_size"]
    return placed.join(odd, "digest", "left_anti").select(columns).unionByName(
        odd_texts.join(exact, ["digest", "text"]).select(columns))
