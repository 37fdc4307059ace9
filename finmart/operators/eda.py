"""EDA summaries: cost structure and correlation matrices, each in one aggregate."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .clean import numeric_columns

COST_COMPONENTS = [(c, c) for c in ("costofrevenue", "operatingexpenses", "interestexpense")]


def cost_structure(income: DataFrame, components=COST_COMPONENTS) -> DataFrame:
    """Mean of each cost column (NULLs skipped) and its share of the sum, in percent."""
    avgs = income.agg(*[F.avg(c).alias(f"a{i}") for i, (_, c) in enumerate(components)])
    total = sum((F.col(f"a{i}") for i in range(len(components))), F.lit(0.0))
    rows = F.array(*[F.struct(F.lit(label).alias("component"), F.lit(c).alias("column_name"),
                              F.col(f"a{i}").alias("avg_value"),
                              (F.try_divide(F.col(f"a{i}"), total) * 100).alias("share_pct"))
                     for i, (label, c) in enumerate(components)])
    return avgs.select(F.inline(rows))


def guarded_corr(a: str, b: str):
    """Pearson over pairwise-complete rows; NULL (not an error) when a side is constant."""
    ca, cb = F.col(a), F.col(b)
    both = ca.isNotNull() & cb.isNotNull()
    sa = F.stddev_pop(F.when(both, ca))
    sb = F.stddev_pop(F.when(both, cb))
    return F.try_divide(F.covar_pop(ca, cb), sa * sb)


def _pair_sums(batches):
    """One row (i, j, n, mean_i, mean_j, cii, cij, cjj) for each pair i <= j: means and centred sums
    over the rows of this task in which both columns hold values. Batches are merged as they come, so a
    task holds two batches and k x k sums."""
    import numpy as np
    import pandas as pd

    total = None
    for batch in batches:
        x = batch.to_numpy(np.float64)
        m = (~np.isnan(x)).astype(np.float64)
        x0 = np.where(m > 0, x, 0.0)
        shift = x0.sum(0) / np.maximum(m.sum(0), 1)
        d = (x - shift) * m
        d[m == 0] = 0.0
        n = m.T @ m
        safe = np.maximum(n, 1)
        si = d.T @ m                              # sum of column i where j is there
        sq, sx = (d * d).T @ m, d.T @ d
        new = (n, si / safe + shift[:, None], sq - si * si / safe, sx - si * si.T / safe)
        total = new if total is None else _merged(total, new)
    if total is None:
        return
    n, mean, own, cross = total
    i, j = np.triu_indices(len(n))
    yield pd.DataFrame({"i": i, "j": j, "n": n[i, j].astype("int64"), "mi": mean[i, j], "mj": mean[j, i],
                        "cii": own[i, j], "cij": cross[i, j], "cjj": own[j, i]})


def _merged(a, b):
    """Means and centred sums of two sets of rows together."""
    import numpy as np
    n = a[0] + b[0]
    d = b[1] - a[1]
    w = a[0] * b[0] / np.maximum(n, 1)
    return n, a[1] + d * b[0] / np.maximum(n, 1), a[2] + b[2] + w * d * d, a[3] + b[3] + w * d * d.T


def wide_correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``correlation_matrix`` for many columns, in one scan whatever their number: a task reduces its
    rows to the masked cross products of all pairs (matrix products), and the few rows of each pair are
    merged by their counts and means. A constant side gives NULL."""
    cols = columns if columns is not None else numeric_columns(df)
    schema = "col_a string, col_b string, corr double"
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], schema)
    sums = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in cols]) \
        .mapInPandas(_pair_sums, "i int, j int, n long, mi double, mj double, cii double, cij double, cjj double")
    sums = materialize(sums, "pairs")   # read twice: a row a task and pair
    n = F.col("n")
    centre = sums.groupBy("i", "j").agg(F.try_divide(F.sum(n * F.col("mi")), F.sum("n")).alias("ci"),
                                        F.try_divide(F.sum(n * F.col("mj")), F.sum("n")).alias("cj"))
    di, dj = F.col("mi") - F.col("ci"), F.col("mj") - F.col("cj")
    whole = sums.join(centre, ["i", "j"]).groupBy("i", "j").agg(
        F.sum(F.col("cii") + n * di * di).alias("cii"), F.sum(F.col("cjj") + n * dj * dj).alias("cjj"),
        F.sum(F.col("cij") + n * di * dj).alias("cij"))
    names = F.array(*[F.lit(c) for c in cols])
    half = whole.select(F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"),
                        F.try_divide("cij", F.sqrt("cii") * F.sqrt("cjj")).alias("corr"))
    mirrored = half.filter(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    return half.unionByName(mirrored)


def correlation_matrix(df: DataFrame, columns: list[str] | None = None,
                       block: int = 500) -> DataFrame:
    """Long correlation matrix (col_a, col_b, corr) over all ordered pairs.

    Pairs i ≤ j are computed in one aggregate (chunks of ``block`` pairs keep the
    generated code under the method-size limit), then mirrored. Fewer than two
    numeric columns → an empty result.
    """
    cols = columns if columns is not None else numeric_columns(df)
    schema = "col_a string, col_b string, corr double"
    spark = df.sparkSession
    if len(cols) < 2:
        return spark.createDataFrame([], schema)
    pairs = list(combinations_with_replacement(cols, 2))
    parts = None
    for s in range(0, len(pairs), block):
        chunk = pairs[s:s + block]
        agg = df.agg(*[guarded_corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(chunk)])
        cells = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                   F.col(f"p{i}").alias("corr"))
                          for i, (a, b) in enumerate(chunk)])
        part = agg.select(F.inline(cells))
        parts = part if parts is None else parts.unionByName(part)
    mirrored = parts.filter(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    return parts.unionByName(mirrored)
