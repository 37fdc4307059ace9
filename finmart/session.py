"""Session construction and shared-storage helpers."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "finmart",
              shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every finmart plan assumes.

    ANSI mode stays on (Spark 4 default), so every fallible cast/division in the
    library goes through ``try_*``. AQE is on so partition counts, skewed joins
    and broadcast decisions are re-planned from runtime statistics.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.ansi.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if driver_memory:   # counts only if no JVM runs yet
        conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as is.
    Only when nothing is configured (local tests) a fresh scratch folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):   # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="finmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table next to the checkpoint directory.

    Written tables (rather than driver-local folders) survive executor loss.
    """
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/finmart-{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


_made: list[str] = []   # scratch folders of this driver, oldest first


@contextlib.contextmanager
def stage_scope(spark: SparkSession):
    """Delete the scratch folders made inside the block when it ends: put the whole run of a
    query there, result written or collected, because lazy results read those folders."""
    start = len(_made)
    try:
        yield
    finally:
        drop_folders(spark, _made[start:])
        del _made[start:]


def drop_folders(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark):
    """Writes inside the block delete their shuffle files when they end: what is written is read from
    its files from then on. Left to the JVM's garbage collection they lie beside the next stages'."""
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def materialize(df, name: str = "stage", by: str | None = None, passes: int = 1):
    """Cut lineage at a stage boundary by writing a table into the shared checkpoint folder.

    Used where several data-dependent passes (null counts, medians, keys) would
    otherwise each recompute the upstream scan and shuffle. A Parquet write runs the
    plan once (``Dataset.checkpoint`` computes it twice unless cached), survives
    executor loss, and the re-read carries file statistics for join planning. The
    folder is ``spark.checkpoint.dir`` from the session (never a machine-local path
    on a cluster).

    With ``passes`` the rows are computed and written in so many slices of the hash of ``by``, one after
    the other, so only a slice's shuffle files lie on disk at a time. ``by`` has to be a key of the plan's
    aggregates and windows: the condition then reaches the sources and no row is computed twice.
    """
    if passes < 2:
        return materialize_slices([df], name)
    from pyspark.sql import functions as F

    at = F.pmod(F.xxhash64(by), F.lit(passes))
    return materialize_slices([df.filter(at == i) for i in range(passes)], name)


def materialize_slices(slices: list, name: str = "stage"):
    """Frames of one schema, written one after the other into one table that is read back."""
    spark, schema = slices[0].sparkSession, slices[0].schema
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        for i, df in enumerate(slices):
            df.write.mode("append" if i else "overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)   # known schema: no inference job


def release(*landed) -> None:
    """Delete the folders of landed stages that nothing will read again."""
    for df in landed:
        files = df.inputFiles()
        drop_folders(df.sparkSession, [files[0].rpartition("/")[0]] if files else [])


def with_year(fact):
    """A fact with its partition column, the year of ``date_key``."""
    from pyspark.sql import functions as F

    return fact.withColumn("year", F.floor(F.col("date_key") / 10000).cast("int"))
