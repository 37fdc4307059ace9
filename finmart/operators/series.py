"""Windows over long series in pieces, so that one symbol's history spreads over many tasks.

A window partitioned by symbol puts a whole series into one task. Here every row gets its position
inside its series; pieces of a fixed number of rows become the window partitions, and each piece
also gets the last ``halo`` rows of the piece before it, whose results are thrown away. A frame of at
most ``halo`` preceding rows then sees exactly the rows that it would see in the whole series.

A fill that looks back without limit needs one value from further away: the last value that is not
NULL before a piece's first row. It comes from one summary row a piece.

``in_pieces`` hands its function a frame in which ``key`` is (key, piece) and ``order`` is (position,
order, halo), both as structs: any function that partitions by the one and sorts by the other runs
unchanged. Rows with equal order values keep the order that they were numbered in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def positions(df: DataFrame, key: str = "symbol", order: str = "date", name: str = "__pos") -> DataFrame:
    """Adds a row's position (from 0) inside its series, NULL order values last.

    Rows are range-partitioned by (key, order), so a long series covers many tasks, numbered inside
    their task, and shifted by the counts of the tasks before: one summary row a task and series.
    """
    by = [F.col(key), F.col(order).asc_nulls_last()]
    tagged = materialize(df.repartitionByRange(*by).sortWithinPartitions(*by)
                         .withColumn("__task", F.spark_partition_id())
                         .withColumn("__at", F.monotonically_increasing_id()), "series")
    runs = tagged.groupBy(F.col(key).alias("__key"), F.col("__task").alias("__of")).agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__key").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    on = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__task") == F.col("__of"))
    return tagged.join(runs, on).withColumn(name, F.col("__at") - F.col("__first") + F.col("__shift")) \
        .drop("__task", "__at", "__key", "__of", "__first", "__n", "__shift")


def _carried(at: DataFrame, fill: dict[str, str], halo: int, rows: int, key: str) -> DataFrame:
    """(__k, __p, carried columns): the last value that is not NULL before the halo of a piece."""
    w = Window.partitionBy("__k").orderBy("__p")
    inside = F.pmod(F.col("__pos"), F.lit(rows))

    def last(c: str, when=None):
        seen = F.col(c).isNotNull() if when is None else F.col(c).isNotNull() & when
        return F.max_by(c, F.when(seen, F.col("__pos")))

    sums = at.groupBy(F.col(key).alias("__k"), F.floor(F.col("__pos") / rows).alias("__p")).agg(
        *[last(c).alias(f"__all_{c}") for c in fill],
        *[last(c, inside < rows - halo).alias(f"__body_{c}") for c in fill])
    return sums.select("__k", "__p", *[
        F.coalesce(F.lag(f"__body_{c}").over(w),
                   F.last(f"__all_{c}", ignorenulls=True).over(
                       w.rowsBetween(Window.unboundedPreceding, -2))).alias(out)
        for c, out in fill.items()])


def in_pieces(df: DataFrame, fn: Callable[[DataFrame], DataFrame], halo: int, rows: int,
              key: str = "symbol", order: str = "date", fill: dict[str, str] | None = None) -> DataFrame:
    """``fn`` over pieces of ``rows`` rows of each series.

    ``fill`` maps a column to the name under which ``fn`` finds its last value before the piece.
    ``fn`` must pass ``key`` and ``order`` through and make one row for each row."""
    if rows <= halo:
        raise ValueError(f"pieces of {rows} rows cannot lend {halo} of them")
    at = positions(df, key, order)
    piece = F.floor(F.col("__pos") / rows)
    lent = F.pmod(F.col("__pos"), F.lit(rows)) >= rows - halo
    places = F.when(lent, F.array(F.struct(piece.alias("p"), F.lit(False).alias("h")),
                                  F.struct((piece + 1).alias("p"), F.lit(True).alias("h")))) \
        .otherwise(F.array(F.struct(piece.alias("p"), F.lit(False).alias("h"))))
    dealt = at.withColumn("__place", F.explode(places))
    if fill:
        carried = _carried(at, fill, halo, rows, key)
        dealt = dealt.join(carried, F.col(key).eqNullSafe(F.col("__k"))
                           & (F.col("__place.p") == F.col("__p")), "left").drop("__k", "__p")
    dealt = dealt.withColumns({
        key: F.struct(F.col(key).alias("key"), F.col("__place.p").alias("piece")),
        order: F.struct(F.col("__pos").alias("pos"), F.col(order).alias("order"),
                        F.col("__place.h").alias("halo"))}).drop("__pos", "__place")
    out = fn(dealt)
    return out.filter(~F.col(order)["halo"]).withColumns(
        {key: F.col(key)["key"], order: F.col(order)["order"]})


def longest(df: DataFrame, key: str = "symbol") -> int:
    """Rows of the longest series (counts are combined before the shuffle)."""
    return df.groupBy(key).count().agg(F.max("count")).first()[0] or 0
