"""Gold star-schema types and the fixed values the warehouse must reproduce."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the warehouse being replaced) -----------------
# Statement types: key, name, description.
STATEMENT_TYPES = [
    (1, "balance_sheet", "Balance Sheet"),
    (2, "income_statement", "Income Statement"),
    (3, "cash_flow", "Cash Flow Statement"),
]
# Stock metrics in key order 1..9.
STOCK_METRICS = [
    "open", "high", "low", "close", "volume",
    "pct_change", "daily_return", "volatility_5d", "volatility_20d",
]
# Columns of a cleaned statement that are identifiers, not metrics.
NON_METRIC_COLUMNS = ["symbol", "date", "reportedcurrency", "fiscaldateending"]
# Constant attributes of every company row, and the unit of every metric.
COMPANY_INDUSTRY = "Technology"
COMPANY_EXCHANGE = "NASDAQ"
METRIC_UNIT = "USD"
# Symbol used when a dataset carries neither `symbol` nor `ticker`.
DEFAULT_SYMBOL = "GOOGL"
# Model features in training order, and the label.
FEATURES = [
    "open", "high", "low", "close", "volume",
    "pct_change", "daily_return", "volatility_5d", "volatility_20d",
]
# ---------------------------------------------------------------------------

STATEMENT_ORDER = [name for _, name, _ in STATEMENT_TYPES]
FIN_TYPE_KEY = {name: key for key, name, _ in STATEMENT_TYPES}
STOCK_METRIC_KEY = {name: i + 1 for i, name in enumerate(STOCK_METRICS)}

I, S, D, B, DT = T.IntegerType(), T.StringType(), T.DoubleType(), T.BooleanType(), T.DateType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


GOLD = {
    "dim_date": _struct(("date_key", I, False), ("date", DT, True), ("day", I, True),
                        ("month", I, True), ("month_name", S, True), ("quarter", S, True),
                        ("year", I, True), ("day_of_week", I, True), ("is_weekend", B, True)),
    "dim_company": _struct(("company_key", I, False), ("ticker", S, True),
                           ("company_name", S, True), ("industry", S, True),
                           ("exchange", S, True)),
    "dim_fin_statement_type": _struct(("fin_type_key", I, False), ("statement_type", S, True),
                                      ("description", S, True)),
    "dim_fin_metric": _struct(("metric_key", I, False), ("metric_name", S, True),
                              ("metric_group", S, True), ("unit", S, True)),
    "dim_stock_metric": _struct(("stock_metric_key", I, False), ("metric_name", S, True)),
    "fact_finance": _struct(("fact_finance_id", T.LongType(), False), ("date_key", I, True),
                            ("company_key", I, True), ("fin_type_key", I, True),
                            ("metric_key", I, True), ("value", D, True)),
    "fact_stock_prices": _struct(("fact_price_id", T.LongType(), False), ("date_key", I, True),
                                 ("company_key", I, True), ("stock_metric_key", I, True),
                                 ("value", D, True)),
}

PRIMARY_KEYS = {
    "dim_date": ["date_key"],
    "dim_company": ["company_key"],
    "dim_fin_statement_type": ["fin_type_key"],
    "dim_fin_metric": ["metric_key"],
    "dim_stock_metric": ["stock_metric_key"],
    "fact_finance": ["fact_finance_id"],
    "fact_stock_prices": ["fact_price_id"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("fact_finance", "date_key", "dim_date", "date_key"),
    ("fact_finance", "company_key", "dim_company", "company_key"),
    ("fact_finance", "fin_type_key", "dim_fin_statement_type", "fin_type_key"),
    ("fact_finance", "metric_key", "dim_fin_metric", "metric_key"),
    ("fact_stock_prices", "date_key", "dim_date", "date_key"),
    ("fact_stock_prices", "company_key", "dim_company", "company_key"),
    ("fact_stock_prices", "stock_metric_key", "dim_stock_metric", "stock_metric_key"),
]

def ddl(table: str) -> str:
    """Column list of a Gold table as SQL DDL text."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in GOLD[table].fields)
