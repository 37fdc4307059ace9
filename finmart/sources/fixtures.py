"""Map the driver's TPC-H-style tables onto the two input shapes finmart consumes.

* **prices** (daily bars) come from ``lineitem ⋈ supplier``: the symbol is the supplier's name,
  one bar per (supplier, ship date); open/close are the extended price of the first / last line
  of the day by (order key, line number, price), high/low the extremes, volume the line count.
* **statements** (quarterly, wide, camelCase like a vendor download) come from
  ``lineitem ⋈ supplier ⋈ part`` grouped by (supplier, quarter of ship date), so statement and
  price symbols share one company dimension and both grow with the data.

Some measures are reported only from a given year (NULL before), one metric is
never reported (an all-NULL column) and ``netIncome`` appears in two statements,
so the cleaning and star-schema rules all have something to act on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import quarter_end
from ..session import materialize

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: A stage over the lines is landed in passes of about so many of them, but in no more passes than
#: that: each reads the columns of all lines again, and the shuffle files of one lie on disk.
LINES_A_PASS, MOST_PASSES = 1_500_000, 8


def line_passes(spark: SparkSession, sf_dir: str) -> int:
    """In how many passes stages over the lines are landed (a count from file footers)."""
    return max(1, min(MOST_PASSES, -(-read_table(spark, sf_dir, "lineitem").count() // LINES_A_PASS)))


def prices_from_lines(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Daily OHLCV bars per (symbol, date); min_by/max_by aggregate partially map-side. The price
    is part of the order of a day's lines, so lines that repeat a key leave no tie."""
    turn = F.struct("l_orderkey", "l_linenumber", "l_extendedprice")
    return (lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
            .join(supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy(F.col("s_name").alias("symbol"), F.col("l_shipdate").cast("date").alias("date"))
            .agg(F.min_by("l_extendedprice", turn).alias("open"),
                 F.max("l_extendedprice").alias("high"),
                 F.min("l_extendedprice").alias("low"),
                 F.max_by("l_extendedprice", turn).alias("close"),
                 F.count(F.lit(1)).alias("volume"))
            .select("date", "open", "high", "low", "close", "volume", "symbol"))


def prices_from_events(events: DataFrame) -> DataFrame:
    """Second bar shape: ticks (event_type as symbol) rolled up to daily bars."""
    return (events
            .groupBy(F.col("event_type").alias("symbol"), F.col("ts").cast("date").alias("date"))
            .agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"),
                 F.min("value").alias("low"), F.max_by("value", "ts").alias("close"),
                 F.count(F.lit(1)).alias("volume"))
            .select("date", "open", "high", "low", "close", "volume", "symbol"))


def _units(c: str, places: int = 2):
    """A 2-decimal amount as an exact integer count of 10^-places units."""
    return F.round(F.col(c) * (10 ** places)).cast("long")


_HALF = 1 << 20


def exact_sum(term, scale: int):
    """Sum of an integer ``term`` (units of 10^-scale) as DOUBLE, the same in any merge order.

    The term's high and low part are summed as longs, which is exact, and joined once at the end;
    a part cannot overflow before the total passes 2^63 x 2^20 units.
    """
    high = F.sum(F.floor(term / F.lit(_HALF)).cast("long"))
    low = F.sum(F.pmod(term, F.lit(_HALF)))
    return (high.cast("double") * F.lit(float(_HALF)) + low.cast("double")) / F.lit(float(10 ** scale))


def quarterly_ledger(lineitem: DataFrame, supplier: DataFrame, part: DataFrame) -> DataFrame:
    """One aggregate over all line items holding every statement measure.

    Each statement is a projection of this one aggregate, so a plan that uses all
    three statements shuffles line items once (the exchange is reused). Amounts
    are integer unit counts (cents and their products) summed exactly, independent of
    summation order, and exposed as DOUBLE, the warehouse's amount type.
    """
    ep, disc, tax = _units("l_extendedprice"), _units("l_discount"), _units("l_tax")
    qty, retail = _units("l_quantity"), _units("p_retailprice")
    cost = qty * retail                               # 10^-4
    flag = F.col("l_returnflag")
    li = lineitem.select("l_suppkey", "l_partkey", "l_quantity", "l_extendedprice",
                         "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    joined = (li.join(supplier.select("s_suppkey", "s_name"),
                      F.col("l_suppkey") == F.col("s_suppkey"))
              .join(part.select("p_partkey", "p_retailprice"),
                    F.col("l_partkey") == F.col("p_partkey")))
    measures = {
        "revenue": exact_sum(ep * (100 - disc), 4),
        "cogs": exact_sum(cost * 5, 5),
        "opex": exact_sum(ep * disc, 4),
        "interest": exact_sum(F.when((flag == "R") & (disc >= 9), ep), 2),
        "tax": exact_sum(ep * tax, 4),
        "net": exact_sum((ep * (100 - disc) - ep * disc - ep * tax) * 10 - cost * 5, 5),
        "gross": exact_sum(ep, 2),
        "liabilities": exact_sum(ep * (disc + tax) * 4, 4),
        "inventory": exact_sum(F.when(flag != "N", qty), 2),
        "lines": F.count(F.lit(1)).cast("double"),
        "operating_cf": exact_sum(ep * (100 - disc) * (100 + tax) - cost * 50, 6),
        "capex": exact_sum(cost, 5),
        "receivables": exact_sum(F.when(flag == "A", ep), 2),
    }
    return (joined
            .groupBy(F.col("s_name").alias("symbol"),
                     quarter_end(F.col("l_shipdate")).alias("quarter_end"))
            .agg(*[m.alias(k) for k, m in measures.items()]))


def _year(c):
    return F.year(F.col(c))


def _reported_from(year: int, value):
    return F.when(_year("quarter_end") >= year, value)


def _header(ledger: DataFrame):
    return [F.date_format("quarter_end", "yyyy-MM-dd").alias("fiscalDateEnding"),
            F.lit("USD").alias("reportedCurrency")]


def income_statement_raw(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        *_header(ledger),
        F.col("revenue").alias("totalRevenue"),
        F.col("cogs").alias("costOfRevenue"),
        F.col("opex").alias("operatingExpenses"),
        _reported_from(1997, F.col("interest")).alias("interestExpense"),
        F.col("tax").alias("incomeTaxExpense"),
        F.lit(None).cast("double").alias("depreciation"),
        F.col("net").alias("netIncome"),
        F.col("symbol"))


def balance_sheet_raw(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        *_header(ledger),
        F.col("gross").alias("totalAssets"),
        F.col("liabilities").alias("totalLiabilities"),
        _reported_from(1996, F.col("inventory")).alias("inventory"),
        (F.col("lines") * 1000.0).alias("commonStock"),
        _reported_from(2000, F.lit(-1000000.0)).alias("treasuryStock"),
        F.lit(None).cast("double").alias("investments"),
        (F.col("gross") - F.col("liabilities")).alias("totalShareholderEquity"),
        F.col("symbol"))


def cash_flow_raw(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        *_header(ledger),
        F.col("operating_cf").alias("operatingCashflow"),
        (-F.col("capex")).alias("cashflowFromInvestment"),
        (-F.col("tax")).alias("cashflowFromFinancing"),
        F.when(F.quarter("quarter_end") == 4, -0.01 * F.col("receivables"))
         .alias("changeInReceivables"),
        F.lit(None).cast("double").alias("dividendPayout"),
        F.col("net").alias("netIncome"),
        F.col("symbol"))


STATEMENT_BUILDERS = {
    "balance_sheet": balance_sheet_raw,
    "income_statement": income_statement_raw,
    "cash_flow": cash_flow_raw,
}


def raw_statements(spark: SparkSession, sf_dir: str, land: bool = True) -> dict[str, DataFrame]:
    """The three Bronze statements, projections of one quarterly ledger.

    With ``land`` the ledger is checkpointed once (the Bronze landing), so the
    data-dependent cleaning passes re-read it instead of re-aggregating every
    line item.
    """
    ledger = quarterly_ledger(read_table(spark, sf_dir, "lineitem"),
                              read_table(spark, sf_dir, "supplier"),
                              read_table(spark, sf_dir, "part"))
    if land:
        ledger = materialize(ledger, by="symbol", passes=line_passes(spark, sf_dir))
    return {name: build(ledger) for name, build in STATEMENT_BUILDERS.items()}


def raw_prices(spark: SparkSession, sf_dir: str, land: bool = True) -> DataFrame:
    """Bronze daily bars (landed once, like the statements)."""
    bars = prices_from_lines(read_table(spark, sf_dir, "lineitem"),
                             read_table(spark, sf_dir, "supplier"))
    return materialize(bars, by="symbol", passes=line_passes(spark, sf_dir)) if land else bars


def raw_sources(spark: SparkSession, sf_dir: str, land: bool = True) -> dict[str, DataFrame]:
    """All four Bronze datasets."""
    out = raw_statements(spark, sf_dir, land)
    out["prices"] = raw_prices(spark, sf_dir, land)
    return out
