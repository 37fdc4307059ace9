"""Exact quantiles without gathering a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import cumulative_start

#: Distinct values that a task joins with their group's positions, where groups are many.
TASK_ROWS = 200_000


def exact_quantiles_long(long: DataFrame, group_col: str, value_col: str,
                         probs: list[float], many_groups: bool = False) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value_col`` per ``group_col``.

    1. ``(group, value) → count`` is aggregated first (map-side), so a hot repeated
       value — even a third of all rows — becomes a single row before any shuffle.
    2. The distinct values are range-sorted across the cluster and each gets the
       position where its run of copies starts (a weighted cumulative count); the
       keys are unique, so positions are deterministic under task retries.
    3. Per group, the one or two positions each quantile needs are joined back on
       the group key (one small row per group) and the covering values weighted.

    With ``many_groups`` (symbols by month, say; ``group_col`` may be a struct) the positions
    meet the values in a shuffle join instead of a broadcast one, over as many partitions as there
    are ``TASK_ROWS`` values, so that a task's memory does not grow with the table.

    Returns ``(group_col, p, q)``; NULL values are ignored. For p = 0.5 this is the
    mean of the middle two on even counts, as ``median`` defines it.
    """
    counted = (long.select(group_col, value_col).filter(F.col(value_col).isNotNull())
               .groupBy(group_col, value_col).agg(F.count(F.lit(1)).alias("_cnt")))
    runs = cumulative_start(counted, [group_col, value_col], "_cnt", "_start")
    if many_groups:   # one exchange: the totals, the join and the sums all use it
        cores = long.sparkSession.sparkContext.defaultParallelism
        runs = runs.repartition(max(cores, -(-runs.count() // TASK_ROWS)), group_col)
    totals = runs.groupBy(group_col).agg(F.min("_start").alias("_first"),
                                         F.sum("_cnt").alias("_n"))
    pos = F.col("p") * (F.col("_n") - 1)
    lo, hi = F.floor(pos), F.ceil(pos)
    one = F.array(F.struct(F.col("p"), lo.alias("k"), F.lit(1.0).alias("w")))
    two = F.array(F.struct(F.col("p"), lo.alias("k"), (hi - pos).alias("w")),
                  F.struct(F.col("p"), hi.alias("k"), (pos - lo).alias("w")))
    targets = (totals
               .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
               .groupBy(group_col, "_first")
               .agg(F.flatten(F.collect_list(F.when(lo == hi, one).otherwise(two)))
                    .alias("_targets")))
    local = F.col("_start") - F.col("_first")
    # one target row per group; few groups (the columns of a table): the values stay where they are
    picked = (runs.join(targets if many_groups else F.broadcast(targets), group_col)
              .select(group_col, value_col, local.alias("_lo"),
                      (local + F.col("_cnt")).alias("_hi"), F.explode("_targets").alias("t"))
              .filter((F.col("t.k") >= F.col("_lo")) & (F.col("t.k") < F.col("_hi"))))
    return picked.groupBy(group_col, F.col("t.p").alias("p")).agg(
        F.sum(F.col("t.w") * F.col(value_col)).alias("q"))
