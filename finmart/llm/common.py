"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import pathlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, release


#: Bytes of an Arrow batch on the way to Python, whatever the number of rows: texts vary in length.
ARROW_BYTES = "16m"


def ship(spark: SparkSession) -> None:
    """Let the session's Python workers import this package from where it is installed (they need
    not share the driver's working folder), and bound their batches by bytes. A cluster without
    the package takes it by ``--py-files``."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    env = spark.sparkContext.environment
    top = str(pathlib.Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if top not in paths:
        env["PYTHONPATH"] = os.pathsep.join([top, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark (the folder may be any Hadoop path)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a stage into the shared checkpoint folder and read it back: lineage is cut, the
    stage runs once, and a lost executor costs a re-read of files instead of a re-run."""
    out = materialize(df, f"llm-{name}")
    gc.collect()   # what else only dead plans refer to: Spark's cleaner acts on the JVM's collection
    df.sparkSession._jvm.System.gc()
    return out


_kept: dict = {}


def kept_in_worker(key, build: Callable):
    """The one object that a Python worker keeps between tasks. Workers outlive stages: asking for
    another object drops the one before, so that caches of earlier stages do not add up."""
    if key not in _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _kept[key] = build()
    return _kept[key]


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_bucket(id_col: str, buckets: int):
    """crc32 of the id written as decimal text, modulo ``buckets`` (a NULL id: NULL)."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(buckets)


def few(df: DataFrame, id_col: str, want: int, seed: int) -> DataFrame:
    """About ``want`` rows (all, if there are fewer), chosen by a hash of the id.

    The count is a column-pruned scan; the choice does not depend on partitions or retries.
    """
    n = max(1, df.count())
    if n <= want:
        return df
    scale = 1 << 30
    cut = int(scale * min(1.0, want / n))
    return df.filter(F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(scale)) < cut)


#: Bits of a key filter at most (16 MB); beyond it the filter only lets more rows through.
MOST_BITS = 1 << 27
_BLOCK_BITS = 1 << 19


def maybe_in(keys: DataFrame, column: str) -> Callable[[Column], Column]:
    """A predicate that is true for every value of ``keys[column]`` and for few others (a Bloom
    filter of some ten bits a key). It thins out rows with long texts before an exact step; it
    decides nothing by itself. The bits are set on the executors, block by block."""
    spark = keys.sparkSession
    bits = 1 << 16
    while bits < min(MOST_BITS, 10 * keys.count()):
        bits <<= 1

    def places(c: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(c, F.lit(k)), F.lit(bits)) for k in (1, 2)]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for rows in batches:
            at = rows.column(0).to_numpy()
            for b in np.unique(at // _BLOCK_BITS).tolist():
                block = blocks.setdefault(b, np.zeros(_BLOCK_BITS, bool))
                block[at[at // _BLOCK_BITS == b] % _BLOCK_BITS] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(blocks), pa.int64()),
             pa.array([np.packbits(x).tobytes() for x in blocks.values()], pa.binary())],
            names=["block", "bits"])

    at = keys.select(F.explode(F.array(*places(F.col(column)))).alias("at"))
    made = at.repartition(F.floor(F.col("at") / _BLOCK_BITS)).mapInArrow(fill, "block long, bits binary")
    table = np.zeros(max(bits, _BLOCK_BITS), bool)
    for r in made.collect():
        start = r.block * _BLOCK_BITS
        table[start:start + _BLOCK_BITS] = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8))
    shared = spark.sparkContext.broadcast(np.packbits(table))

    @F.pandas_udf("boolean")
    def maybe(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.ones(len(a), bool)
        for x in (a.to_numpy(), b.to_numpy()):
            out &= (shared.value[x >> 3] >> (7 - (x & 7)) & 1).astype(bool)
        return pd.Series(out)

    return lambda c: maybe(*places(c))


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One half-step of the alternating star contraction over (u, v) pairs with u > v."""
    if large:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        out = both.join(low, "u").filter(F.col("v") > F.col("u")) \
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        out = pairs.join(low, "u").filter(F.col("v") != F.col("m")) \
            .select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(low.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has an edge to another.

    Alternating large-star / small-star contraction; every round is landed, so lineage does
    not grow, minima are pre-aggregated before the shuffle, and the joins are plain equi-joins
    that AQE can split when one id holds much of the graph. Ends when a round changes nothing.
    """
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    pairs = edges.select(hi.alias("u"), lo.alias("v")).filter(F.col("u") != F.col("v")).distinct()
    pairs, seen = land(pairs, "cc"), None
    while True:
        last, pairs = pairs, land(_star(_star(pairs, True), False), "cc")
        release(last)
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")),
                        F.sum(F.xxhash64("v", "u") % F.lit(1 << 31))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    low = pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).union(low)
