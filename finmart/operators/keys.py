"""Dense surrogate keys (position + 1 in a total order) without a one-task sort.

``row_number().over(Window.orderBy(...))`` moves every row into one partition.
Here rows are range-partitioned on the order, numbered inside each partition,
and shifted by the row count of all earlier partitions. The per-partition counts
table has one row per partition, so broadcasting it is bounded by the partition
count, not the data.

The range partitioner samples its bounds per execution, so the tagged rows are
materialised once (a table in the checkpoint folder) before the two passes that read them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, materialize, materialize_slices


def dense_index(df: DataFrame, order: list[Column | str], name: str, start: int = 1,
                dtype: str = "bigint") -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order`` (which must be total)."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    tagged = (df.repartitionByRange(*order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_mono", F.monotonically_increasing_id()))
    tagged = materialize(tagged, "keys")
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_offset"))
    local_pos = F.col("_mono") - F.shiftleft(F.col("_part").cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.coalesce(F.col("_offset"), F.lit(0)) + local_pos + start)
                        .cast(dtype))
            .drop("_part", "_mono", "_offset"))


def cumulative_start(df: DataFrame, order: list[Column | str], weight: str,
                     name: str) -> DataFrame:
    """Add ``name`` = total ``weight`` of all rows before this one in ``order`` (total).

    The weighted form of ``dense_index``: rows are range-partitioned and sorted,
    materialised once, and each row's start is its partition's offset (a broadcast
    table with one row per partition) plus the running weight inside its partition.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    tagged = (df.repartitionByRange(*order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_mono", F.monotonically_increasing_id()))
    tagged = materialize(tagged, "runs")
    sums = tagged.groupBy("_part").agg(F.sum(weight).alias("_w"))
    offsets = sums.select("_part", F.sum("_w").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_offset"))
    inside = F.sum(weight).over(Window.partitionBy("_part").orderBy("_mono")
                                .rowsBetween(Window.unboundedPreceding, -1))
    return (tagged.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.coalesce(F.col("_offset"), F.lit(0))
                        + F.coalesce(inside, F.lit(0)))
            .drop("_part", "_mono", "_offset"))


def _missing_before(block: str, columns: list[str]):
    """Adds to rows in order, inside each task and ``block``: ``_at`` (rows before this one) and, by
    column, ``_m<i>`` (rows before this one that lack it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, at, lacking = None, 0, np.zeros(len(columns), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column(block).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1), len(blocks)]
            null = [np.asarray(batch.column(c).is_null()).astype(np.int64) for c in columns]
            places = np.empty(len(blocks), np.int64)
            before = np.empty((len(columns), len(blocks)), np.int64)
            for start, end in zip(cuts, cuts[1:]):
                if blocks[start] != current:
                    current, at = blocks[start], 0
                    lacking = np.zeros(len(columns), np.int64)
                places[start:end] = np.arange(at, at + end - start)
                at += end - start
                for i, mask in enumerate(null):
                    upto = np.cumsum(mask[start:end])
                    before[i, start:end] = lacking[i] + upto - mask[start:end]
                    lacking[i] += upto[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(places), *[pa.array(b) for b in before]],
                names=[*batch.schema.names, "_at", *[f"_m{i}" for i in range(len(columns))]])
    return run


#: Tasks of a slice at most: keeps the task numbers of slices apart.
_SLICE_TASKS = 1 << 20


def date_slices(df: DataFrame, passes: int, date: str = "date") -> list[Column]:
    """Conditions on ``date``, in order, that cut the rows into at most ``passes`` stretches of about
    the same size. The table of dates is bounded by the calendar."""
    days = df.groupBy(date).agg(F.count(F.lit(1)).alias("n")).na.drop().orderBy(date).collect()
    total, before, starts = sum(r.n for r in days), 0, []
    for r in days:
        if before * passes >= total * (len(starts) + 1):
            starts.append(r[0])
        before += r.n
    edges = [None, *starts, None]
    return [(F.lit(True) if a is None else F.col(date) >= F.lit(a))
            & (F.lit(True) if b is None else F.col(date) < F.lit(b)) for a, b in zip(edges, edges[1:])]


def index_cells(df: DataFrame, block: str, order: list[Column | str], columns: list[str],
                copies: dict[int, list[int]], keep: list[str], start: int = 1,
                slices: list[Column] | None = None) -> DataFrame:
    """Long rows (block, *keep, cell, copy, value, id) of a wide table's cells that are not NULL.

    ``id`` is the position of a cell in the order (block, column, ``order``), which the wide rows alone
    give: they are sorted once by (block, ``order``), and a cell's position is that of its row less
    the rows before it that lack the column, behind the cells of earlier columns and tasks. So the
    sort and what is landed grow with the rows, not with rows x columns. ``copies`` says, by block,
    how many rows a cell of each column becomes. The table of offsets has one row a task and block.
    ``slices`` are conditions that cut the order (of a single block) into stretches, first to last: each is
    sorted and landed by itself, so only its rows are shuffled at a time.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    by = [F.col(block), *[F.col(c) if isinstance(c, str) else c for c in order]]

    def placed(rows: DataFrame, at: int = 0) -> DataFrame:
        part = (F.spark_partition_id() + at * _SLICE_TASKS).alias("_part")
        sorted_rows = (rows.repartitionByRange(*by).sortWithinPartitions(*by)
                       .select(part, block, *keep, *columns))
        schema = T.StructType([*sorted_rows.schema.fields, T.StructField("_at", T.LongType()),
                               *[T.StructField(f"_m{i}", T.LongType()) for i in range(len(columns))]])
        return sorted_rows.mapInArrow(_missing_before(block, columns), schema)

    if slices and len(slices) > 1:
        tagged = materialize_slices([placed(df.filter(only), i) for i, only in enumerate(slices)], "keys")
    else:
        tagged = materialize(placed(df), "keys")

    def each(value):   # one entry a column, by block
        out = F.lit(None)
        for b, times in copies.items():
            out = F.when(F.col(block) == b, F.array(*[value(i, n) for i, n in enumerate(times)])).otherwise(out)
        return out

    counts = tagged.groupBy("_part", block).agg(*[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)])
    counts = counts.select("_part", block, F.posexplode(each(lambda i, n: F.col(f"_n{i}") * n))
                           .alias("_cell", "_n"))
    before = Window.orderBy(block, "_cell", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_o", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .groupBy("_part", block).agg(F.array_sort(F.collect_list(F.struct("_cell", "_o"))).alias("_o")))

    def cell(i, n):
        first = F.col("_o")[i]["_o"] + (F.col("_at") - F.col(f"_m{i}")) * n + start
        return F.array(*[F.struct(F.lit(i).alias("cell"), F.lit(k).alias("copy"),
                                  F.col(columns[i]).alias("value"), (first + k).alias("id")) for k in range(n)])
    return (tagged.join(F.broadcast(offsets), ["_part", block])
            .select(block, *keep, F.inline_outer(F.flatten(each(cell)))).filter(F.col("value").isNotNull()))
