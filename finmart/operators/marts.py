"""Gold → marts: the wide and long tables behind the dashboard and charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent_change
from ..schemas import STOCK_METRICS


def _company_keys(dim_company_df: DataFrame, ticker: str) -> DataFrame:
    """Key(s) of one ticker; a filtered dimension, so its size is that of one company."""
    return F.broadcast(dim_company_df.filter(F.col("ticker") == F.lit(ticker))
                       .select("company_key"))


def _date_key_range(start: str | None, end: str | None, by_year: bool = False):
    """yyyyMMdd bounds as an integer predicate on ``date_key`` (pushed to the fact scan), and on
    the partition column of a fact that is stored by year."""
    cond = F.lit(True)
    if by_year and start:
        cond = cond & (F.col("year") >= int(start[:4]))
    if by_year and end:
        cond = cond & (F.col("year") <= int(end[:4]))
    if start:
        cond = cond & (F.col("date_key") >= int(start.replace("-", "")))
    if end:
        cond = cond & (F.col("date_key") <= int(end.replace("-", "")))
    return cond


def prices_wide(fact_stock_prices_df: DataFrame, dim_company_df: DataFrame,
                dim_date_df: DataFrame, dim_stock_metric_df: DataFrame,
                ticker: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """One row per date with a column per stock metric (duplicates averaged).

    The ticker lookup is a semi-join, so an unknown ticker yields an empty table
    without a driver round trip; the pivot always gets the fixed metric list. An
    optional inclusive date range becomes a ``date_key`` predicate on the fact scan.
    """
    by_year = "year" in fact_stock_prices_df.columns
    fact = (fact_stock_prices_df.filter(_date_key_range(start, end, by_year)).drop("year")
            .join(_company_keys(dim_company_df, ticker), "company_key", "left_semi"))
    merged = (fact.join(F.broadcast(dim_date_df.select("date_key", "date")), "date_key")
              .join(F.broadcast(dim_stock_metric_df), "stock_metric_key"))
    wide = merged.groupBy("date").pivot("metric_name", STOCK_METRICS).agg(F.avg("value"))
    return wide.withColumn("symbol", F.lit(ticker)).orderBy("date")


def statement_long(fact_finance_df: DataFrame, dim_company_df: DataFrame,
                   dim_date_df: DataFrame, dim_fin_metric_df: DataFrame, ticker: str,
                   fin_type_key: int) -> DataFrame:
    """Facts of one ticker and statement type with date and metric attributes."""
    fact = (fact_finance_df.drop("year").filter(F.col("fin_type_key") == fin_type_key)
            .join(_company_keys(dim_company_df, ticker), "company_key", "left_semi"))
    return (fact.join(F.broadcast(dim_date_df), "date_key")
            .join(F.broadcast(dim_fin_metric_df), "metric_key")
            .orderBy("date", "metric_key"))


def statement_matrix(long: DataFrame, dates: list[str]) -> DataFrame:
    """metric_name × date matrix; a duplicated (metric, date) cell is an error.

    ``dates`` (yyyy-MM-dd) are the columns: one pass, in which a duplicate or a date that is
    not among them stops the query instead of going unseen.
    """
    label = F.date_format("date", "yyyy-MM-dd")
    listed = F.when(label.isin(dates), label).otherwise(F.raise_error(F.concat(
        F.lit("a date has no column in the matrix: "), F.coalesce(label, F.lit("NULL")))).cast("string"))
    cell = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(
        F.lit("duplicate cell in the matrix: "), F.first("metric_name"))).cast("double")) \
        .otherwise(F.first("value"))
    return (long.withColumn("date_label", listed)
            .groupBy("metric_name").pivot("date_label", dates).agg(cell))


def default_metrics(long: DataFrame, n: int = 2) -> DataFrame:
    """The first ``n`` distinct metrics of a statement (by metric key)."""
    return long.select("metric_key", "metric_name").distinct().orderBy("metric_key").limit(n)


def metric_trend(long: DataFrame, metrics: list[str] | None = None, n: int = 2) -> DataFrame:
    """(date, metric_name, value) for the chosen metrics, defaulting to the first ``n``."""
    if metrics:
        chosen = long.filter(F.col("metric_name").isin(metrics))
    else:
        chosen = long.join(F.broadcast(default_metrics(long, n).select("metric_name")),
                           "metric_name", "left_semi")
    return chosen.select("date", "metric_name", "value").orderBy("date", "metric_name")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def date_bounds(df: DataFrame, by: str | None = None) -> DataFrame:
    aggs = [F.min("date").alias("min_date"), F.max("date").alias("max_date"),
            F.count(F.lit(1)).alias("row_count")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def price_range(wide: DataFrame, start: str, end: str) -> DataFrame:
    """Candles and volume between two dates, inclusive (on an already built wide mart;
    ``prices_wide(start=, end=)`` applies the same range at the fact scan)."""
    return (wide.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
            .select("date", "open", "high", "low", "close", "volume")
            .orderBy("date"))


def latest_kpis(prices: DataFrame, key: str = "symbol") -> DataFrame:
    """Latest bar per symbol with its change against the previous bar."""
    w = Window.partitionBy(key).orderBy("date")
    last = Window.partitionBy(key)
    return (prices
            .withColumn("prev_close", F.lag("close").over(w))
            .withColumn("__last", F.max("date").over(last))
            .filter(F.col("date") == F.col("__last"))
            .select(key, "date", "close", "open", "high", "low", "prev_close",
                    (F.col("close") - F.col("prev_close")).alias("change"),
                    percent_change("close", "prev_close").alias("change_pct")))


def series(df: DataFrame, columns: list[str], key: str = "symbol") -> DataFrame:
    """A date-ordered projection (the data behind a line chart)."""
    keep = [key] if key in df.columns else []
    return df.select(*keep, "date", *columns).orderBy(*keep, "date")


def price_volume_series(prices: DataFrame) -> DataFrame:
    return series(prices, ["close", "volume"])


def revenue_series(income: DataFrame) -> DataFrame:
    return series(income, ["totalrevenue"])


def cashflow_series(cash_flow: DataFrame, long: bool = False) -> DataFrame:
    cols = ["operatingcashflow", "cashflowfrominvestment", "cashflowfromfinancing"]
    wide = series(cash_flow, cols)
    if not long:
        return wide
    return wide.unpivot(["symbol", "date"], cols, "component", "value")


def assets_series(balance: DataFrame) -> DataFrame:
    return series(balance, ["totalassets"])
