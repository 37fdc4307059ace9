"""Rendezvous sharding of stable keys over weighted shards, in DataFrame expressions only.

Every (key, shard) pair gets a uniform u from an md5; the shard with the largest
``-weight / ln(u)`` takes the key. A shard's score for a key depends on nothing but the two, so
one more shard can only take keys into itself: about ``w / sum(w)`` of the rows move, none
between old shards. Null keys hash as the text ``null``; a null text counts as empty. Rows that
repeat a key go to the same shard and get slots of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slots are numbered inside (shard, first three hex digits of the key's md5): 4096 groups a
#: shard, so no shard is ordered in one task. The offsets table has shards x 4096 rows at most.
SLOT_DIGITS = 3


def _key(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit("null"))


def _score(key: Column, shard: int, weight: float) -> Column:
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{shard}"))), 1, 13), 16, 10)
    u = (bits.cast("double") + F.lit(1.0)) / F.lit(float(2 ** 52 + 1))
    return F.lit(-float(weight)) / F.ln(u)


def _winner(key: Column, weights: list[float], first: int = 0, best: Column | None = None) -> Column:
    """struct(score, -shard): ties go to the smaller shard number."""
    scored = [F.struct(_score(key, s, w).alias("score"), F.lit(-s).alias("shard"))
              for s, w in enumerate(weights, start=first)]
    scored = ([best] if best is not None else []) + scored
    return F.greatest(*scored) if len(scored) > 1 else scored[0]


def rendezvous(docs: DataFrame, weights: list[float], extra: list[float] | None = None,
               id_col: str = "doc_id") -> DataFrame:
    """``docs`` plus ``shard`` (0 ...) and, when ``extra`` weights are given, ``grown_shard``:
    the shard after those shards are added. Both are one projection; there is no shuffle."""
    key = _key(id_col)
    out = docs.withColumn("__best", _winner(key, weights))
    out = out.withColumn("shard", (-F.col("__best.shard")).cast("int"))
    if extra:
        grown = _winner(key, extra, len(weights), F.col("__best"))
        out = out.withColumn("grown_shard", (-grown["shard"]).cast("int"))
    return out.drop("__best")


def number_slots(sharded: DataFrame, id_col: str = "doc_id", ties: tuple[str, ...] = ()) -> DataFrame:
    """Add ``slot``: 0, 1, 2 ... without gaps inside each shard, in the order of (md5 group, id).

    The group sizes are summed from a scan of the id alone; each group is numbered by itself
    and shifted by the rows of the groups before it.
    """
    group = F.substring(F.md5(_key(id_col)), 1, SLOT_DIGITS)
    rows = sharded.withColumn("__group", group)
    sizes = rows.groupBy("shard", "__group").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__group").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "__group",
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("shard", "__group").orderBy(F.col(id_col), *ties)
    return (rows.withColumn("__at", F.row_number().over(inside) - F.lit(1))
            .join(F.broadcast(offsets), ["shard", "__group"])   # shards x 4096 rows at most
            .withColumn("slot", (F.col("__before") + F.col("__at")).cast("long"))
            .drop("__group", "__before", "__at"))


def shard_documents(docs: DataFrame, shards: int = 24, weights: list[float] | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    weights = weights or [1.0] * shards
    placed = rendezvous(rows, weights, extra=[1.0])
    return number_slots(placed, ties=("text_crc32", "size")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
