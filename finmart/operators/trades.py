"""What signals earned on the bars that followed them: windows over (symbol, date) and aggregates.

A signal is known at the close of its bar, so a trade is entered and left at the next bar's open.
Windows run over one symbol's bars, which the calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .features import series_window
from .indicators import rolling

#: Trading days of a year, for yearly ratios.
YEAR = 252


def crossover(fast: int = 5, slow: int = 20, digits: int = 6) -> Column:
    """True while the fast mean of closes is above the slow one; false until both frames are full.
    Means are compared to ``digits`` places, so that the order of a sum does not decide."""
    means = [F.round(rolling(F.avg, "close", n), digits) for n in (fast, slow)]
    return F.coalesce(means[0] > means[1], F.lit(False))


def positions(prices: DataFrame, signal: Column, key: str = "symbol") -> DataFrame:
    """(key, date, held, entered, left, next_date, next_open, held_return) a bar.

    ``held``: the signal of the bar (a NULL one is false); ``entered`` / ``left``: it differs from
    the bar before; ``held_return``: from the next open to the one after it while held, else 0, and
    NULL where those opens are missing.
    """
    w = series_window(key)
    before = F.coalesce(F.lag("held").over(w), F.lit(False))
    after = F.lead("open", 2).over(w)
    rows = prices.select(key, "date", "open", F.coalesce(signal, F.lit(False)).alias("held"))
    rows = rows.select(key, "date", "held", (F.col("held") & ~before).alias("entered"),
                       (~F.col("held") & before).alias("left"), F.lead("date").over(w).alias("next_date"),
                       F.lead("open").over(w).alias("next_open"), after.alias("after"))
    gain = F.try_divide(F.col("after"), F.col("next_open")) - 1
    return rows.withColumn("held_return", F.when(F.col("held"), gain).when(gain.isNotNull(), F.lit(0.0))) \
        .drop("after")


def trades(held: DataFrame, key: str = "symbol") -> DataFrame:
    """A row per trade of ``positions``: trade number, entry and exit (date, price), bars held and return.

    Exit and return are NULL for a trade that the bars do not end; a signal on the last bar, which
    no open follows, is no trade.
    """
    number = F.sum(F.col("entered").cast("int")).over(
        series_window(key).rowsBetween(Window.unboundedPreceding, 0))
    at = {"entry": "entered", "exit": "left"}
    picked = [F.max(F.when(F.col(flag), F.col(f"next_{c}"))).alias(f"{name}_{p}")
              for name, flag in at.items() for c, p in (("date", "date"), ("open", "price"))]
    runs = held.withColumn("trade", number.cast("int")).filter("held or left").groupBy(key, "trade")
    return (runs.agg(F.count_if("held").alias("bars"), *picked).filter("entry_date is not null")
            .withColumn("trade_return", F.try_divide("exit_price", "entry_price") - 1))


def trade_statistics(held: DataFrame, key: str = "symbol") -> DataFrame:
    """Per series: closed and open trades, win rate, mean return and profit factor of the closed ones
    (gains over losses; NULL without a loss), and the yearly Sharpe ratio of the held returns (NULL
    when they do not vary)."""
    r = F.col("trade_return")
    per_trade = trades(held, key).groupBy(key).agg(
        F.count(r).alias("closed_trades"), F.count_if(r.isNull()).alias("open_trades"),
        F.avg((r > 0).cast("double")).alias("win_rate"), F.avg(r).alias("mean_return"),
        F.try_divide(F.sum(F.when(r > 0, r)), -F.sum(F.when(r < 0, r))).alias("profit_factor"))
    h = F.col("held_return")
    per_bar = held.groupBy(key).agg(
        F.count(F.lit(1)).alias("bars"), F.count_if("held").alias("held_bars"),
        F.try_divide(F.avg(h) * F.sqrt(F.lit(float(YEAR))), F.stddev_samp(h)).alias("sharpe"))
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("closed_trades", "open_trades")}
    return per_bar.join(per_trade, key, "left").withColumns(counts)
