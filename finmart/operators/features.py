"""Price features and the ordered (per-symbol time series) operators.

All windows share ``partitionBy(symbol).orderBy(date)`` so Spark sorts once per
symbol. A symbol's daily series is bounded by the calendar (≈ 252 bars a year). Longer series
(ticks, one ticker alone) go through ``add_price_features_in_pieces``: same rows, many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import pct_change as _pct
from .series import in_pieces


def series_window(key: str = "symbol") -> Window:
    return Window.partitionBy(key).orderBy(F.col("date").asc_nulls_last())


def rolling_std(c: Column | str, n: int, key: str = "symbol") -> Column:
    """Sample std over the last ``n`` rows; NULL until the frame holds ``n`` non-null values."""
    c = F.col(c) if isinstance(c, str) else c
    frame = series_window(key).rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(frame) == n, F.stddev_samp(c).over(frame))


#: Rows that the longest frame of a price feature looks back, the return before it included.
PRICE_HALO = 20
#: A series of more rows than this is windowed in pieces of so many rows.
SERIES_ROWS = 200_000


def add_price_features(prices: DataFrame, key: str = "symbol", before: str | None = None) -> DataFrame:
    """pct_change (over forward-filled close), daily_return, 5/20-row volatility. ``before`` names a
    column with the last close that is known from before the first row."""
    if "close" not in prices.columns:
        return prices
    w = series_window(key)
    filled = F.last("close", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    if before:
        filled = F.coalesce(filled, F.col(before))
    with_ret = (prices
                .withColumn("__ff", filled)
                .withColumn("pct_change", _pct(F.col("__ff"), F.lag("__ff").over(w)))
                .withColumn("daily_return", F.col("close") - F.lag("close").over(w))
                .drop("__ff"))
    return (with_ret
            .withColumn("volatility_5d", rolling_std("pct_change", 5, key))
            .withColumn("volatility_20d", rolling_std("pct_change", 20, key)))


def add_price_features_in_pieces(prices: DataFrame, rows: int = SERIES_ROWS,
                                 key: str = "symbol") -> DataFrame:
    """The rows of ``add_price_features``, each series spread over pieces of ``rows`` rows."""
    if "close" not in prices.columns:
        return prices
    return in_pieces(prices, lambda p: add_price_features(p, key, "__close").drop("__close"),
                     halo=PRICE_HALO, rows=rows, key=key, fill={"close": "__close"})


def training_frame(features: DataFrame, key: str = "symbol") -> DataFrame:
    """Label = next row's pct_change; rows with any NULL are dropped."""
    w = series_window(key)
    return features.withColumn("target", F.lead("pct_change").over(w)).na.drop(how="any")


def train_test_split(frame: DataFrame, train_share: float = 0.8, key: str = "symbol") -> DataFrame:
    """Time-ordered split per symbol: first floor(share·n) rows train, the rest test."""
    w = series_window(key)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    rn = F.row_number().over(w)
    return frame.withColumn(
        "split", F.when(rn <= F.floor(n * F.lit(train_share)), F.lit("train"))
        .otherwise(F.lit("test")))


def latest_rows(df: DataFrame, n: int = 1, key: str = "symbol") -> DataFrame:
    """The last ``n`` rows of each symbol's series (``rank_from_end`` 1 = latest)."""
    w = Window.partitionBy(key).orderBy(F.col("date").desc_nulls_last())
    return df.withColumn("rank_from_end", F.row_number().over(w)).filter(
        F.col("rank_from_end") <= n)
