"""Silver → Gold: dimensions, long-format facts and their surrogate keys.

Join strategy: dimensions whose size is bounded by a schema or a constant list
(statement types, stock metrics, finance metrics = statement columns) are
broadcast explicitly; ``dim_date`` is bounded by the calendar (one row per day).
``dim_company`` grows with the number of companies, so it is left to the planner
and AQE, which broadcast it only when its measured size is under the threshold
and fall back to a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key, is_weekend, iso_weekday, month_name, quarter_label
from ..schemas import (COMPANY_EXCHANGE, COMPANY_INDUSTRY, FIN_TYPE_KEY, GOLD, METRIC_UNIT,
                       STATEMENT_ORDER, STATEMENT_TYPES, STOCK_METRIC_KEY, STOCK_METRICS)
from .clean import metric_columns
from .keys import date_slices, dense_index, index_cells


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast to the declared Gold schema, by name."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in GOLD[table].fields])


# --- dimensions ----------------------------------------------------------------------------

def dim_date(*datasets: DataFrame, check_nonempty: bool = False) -> DataFrame:
    """Distinct non-null dates of all datasets (a sparse set, not a calendar)."""
    dates = None
    for df in datasets:
        d = df.select(F.col("date").cast("date").alias("date"))
        dates = d if dates is None else dates.unionByName(d)
    dates = dates.distinct().na.drop()
    if check_nonempty and dates.isEmpty():
        raise ValueError("dim_date would be empty: no source row has a usable date")
    d = F.col("date")
    out = dates.select(date_key(d).alias("date_key"), d,
                       F.dayofmonth(d).alias("day"), F.month(d).alias("month"),
                       month_name(d).alias("month_name"), quarter_label(d).alias("quarter"),
                       F.year(d).alias("year"), iso_weekday(d).alias("day_of_week"),
                       is_weekend(d).alias("is_weekend"))
    return _conform(out, "dim_date")


def _appearances(statements: dict[str, DataFrame]) -> DataFrame:
    rows = None
    for name in STATEMENT_ORDER:
        if name not in statements:
            continue
        df = statements[name].select(
            "symbol", F.lit(STATEMENT_ORDER.index(name) + 1).alias("stmt_ord"),
            F.col("date").cast("date").alias("date"))
        rows = df if rows is None else rows.unionByName(df)
    return rows


def dim_company(statements: dict[str, DataFrame], check_nonempty: bool = False) -> DataFrame:
    """One row per symbol of the statements, keyed by first appearance.

    Appearance order is statement order, then each statement's row order
    (date descending, as statements are published), so a company's key is set by
    the (statement, newest date) where it is first seen, then by symbol.
    """
    rows = _appearances(statements).na.drop(subset=["symbol"])
    first = rows.groupBy("symbol").agg(
        F.min(F.struct(F.col("stmt_ord"),
                       F.coalesce(-F.unix_date("date"), F.lit(2 ** 31 - 1)).alias("neg_day")))
        .alias("first"))
    if check_nonempty and first.isEmpty():
        raise ValueError("dim_company would be empty: no statement row names a symbol")
    keyed = dense_index(first, [F.col("first.stmt_ord"), F.col("first.neg_day"),
                                F.col("symbol")], "company_key")
    out = keyed.select("company_key", F.col("symbol").alias("ticker"),
                       F.col("symbol").alias("company_name"),
                       F.lit(COMPANY_INDUSTRY).alias("industry"),
                       F.lit(COMPANY_EXCHANGE).alias("exchange"))
    return _conform(out, "dim_company")


def metric_catalog(statements: dict[str, DataFrame]) -> list[tuple[int, str, str, int]]:
    """(metric_key, metric_name, metric_group, column ordinal) from column metadata.

    Statements are concatenated in statement order; a name seen again keeps its
    first row (so ``netincome`` of the cash flow maps to the income-statement row).
    """
    seen, out = set(), []
    for name in STATEMENT_ORDER:
        if name not in statements:
            continue
        for ordinal, col in enumerate(metric_columns(statements[name]), start=1):
            if col in seen:
                continue
            seen.add(col)
            out.append((len(out) + 1, col, name, ordinal))
    return out


def dim_fin_metric(spark: SparkSession, statements: dict[str, DataFrame]) -> DataFrame:
    rows = [(k, n, g, METRIC_UNIT) for k, n, g, _ in metric_catalog(statements)]
    return spark.createDataFrame(rows, GOLD["dim_fin_metric"])


def dim_fin_statement_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATEMENT_TYPES, GOLD["dim_fin_statement_type"])


def dim_stock_metric(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i + 1, n) for i, n in enumerate(STOCK_METRICS)],
                                 GOLD["dim_stock_metric"])


# --- unpivots ------------------------------------------------------------------------------

def unpivot_metrics(df: DataFrame, columns: list[str], ids=("symbol", "date"),
                    name_col: str = "metric_name") -> DataFrame:
    """Wide → long (ids..., metric_name, col_ord, value DOUBLE); NULL values dropped."""
    cells = F.array(*[F.struct(F.lit(c).alias(name_col), F.lit(i).alias("col_ord"),
                               F.col(c).cast("double").alias("value"))
                      for i, c in enumerate(columns, start=1)])
    return (df.select(*ids, F.inline(cells))
            .filter(F.col("value").isNotNull()))


def unpivot_statement(df: DataFrame) -> DataFrame:
    return unpivot_metrics(df, metric_columns(df))


def unpivot_prices(prices: DataFrame) -> DataFrame:
    """The stock metrics present in the table, in key order; key from the fixed list."""
    present = [m for m in STOCK_METRICS if m in prices.columns]
    long = unpivot_metrics(prices, present)
    key = F.create_map(*[x for m in present for x in (F.lit(m), F.lit(STOCK_METRIC_KEY[m]))])
    return long.withColumn("stock_metric_key", key[F.col("metric_name")])


# --- facts ---------------------------------------------------------------------------------

def fact_finance(statements: dict[str, DataFrame], dim_company_df: DataFrame,
                 dim_fin_metric_df: DataFrame, dim_date_df: DataFrame,
                 with_ids: bool = True) -> DataFrame:
    """Unpivot each statement, join company / metric (by name only) / date, union, key.

    Key order: statement, source column position, date descending, symbol. With ids the joins and
    the one sort run on the wide rows (``index_cells``); only the result is long.
    """
    companies = dim_company_df.select("company_key", F.col("ticker").alias("symbol"))
    dates = F.broadcast(dim_date_df.select("date_key", "date"))
    if with_ids:
        return _conform(_keyed_statements(statements, companies, dates, dim_fin_metric_df), "fact_finance")
    metrics = F.broadcast(dim_fin_metric_df.select("metric_key", "metric_name"))
    parts = None
    for name in STATEMENT_ORDER:
        if name not in statements:
            continue
        long = (unpivot_statement(statements[name])
                .join(companies, "symbol")
                .join(metrics, "metric_name")
                .join(dates, "date")
                .withColumn("fin_type_key", F.lit(FIN_TYPE_KEY[name])))
        parts = long if parts is None else parts.unionByName(long)
    return parts


def _keyed_statements(statements: dict[str, DataFrame], companies: DataFrame, dates: DataFrame,
                      dim_fin_metric_df: DataFrame) -> DataFrame:
    """(fact_finance_id, date_key, company_key, fin_type_key, metric_key, value) of all statements.

    Statements share the cell columns by position. The metric dimension has one row a column
    of a statement, so its keys are literals of the plan."""
    keys: dict[str, list[int]] = {}
    for r in dim_fin_metric_df.select("metric_name", "metric_key").collect():
        keys.setdefault(r.metric_name, []).append(r.metric_key)
    names = {FIN_TYPE_KEY[n]: [c for c in metric_columns(statements[n]) if c in keys]
             for n in STATEMENT_ORDER if n in statements}
    width = max([1, *[len(cols) for cols in names.values()]])
    cells = [f"v{i}" for i in range(width)]
    wide = None
    for name in STATEMENT_ORDER:
        if name not in statements:
            continue
        kind = FIN_TYPE_KEY[name]
        values = [F.col(f"`{c}`").cast("double") for c in names[kind]]
        values += [F.lit(None).cast("double")] * (width - len(values))
        rows = (statements[name].select("symbol", "date", *[v.alias(c) for v, c in zip(values, cells)])
                .join(companies, "symbol").join(dates, "date").withColumn("fin_type_key", F.lit(kind)))
        wide = rows if wide is None else wide.unionByName(rows)
    copies = {kind: [len(keys[c]) for c in cols] + [0] * (width - len(cols)) for kind, cols in names.items()}
    long = index_cells(wide, "fin_type_key", [F.col("date").desc(), "symbol"], cells, copies,
                       ["date_key", "company_key"])
    metric = F.lit(None)
    for kind, cols in names.items():
        if cols:
            of_cell = F.array(*[F.array(*[F.lit(k) for k in keys[c]]) for c in cols])
            metric = F.when(F.col("fin_type_key") == kind, of_cell[F.col("cell")][F.col("copy")]).otherwise(metric)
    return long.select(F.col("id").alias("fact_finance_id"), "date_key", "company_key", "fin_type_key",
                       metric.alias("metric_key"), "value")


def fact_stock_prices(prices: DataFrame, dim_company_df: DataFrame, dim_date_df: DataFrame,
                      with_ids: bool = True, passes: int = 1) -> DataFrame:
    """Unpivot the price metrics, map names to keys, join company and date, key.

    Key order: metric key, date, symbol. With ids the joins and the one sort run on the wide rows
    (``index_cells``), in ``passes`` stretches of dates; only the result is long.
    """
    companies = dim_company_df.select("company_key", F.col("ticker").alias("symbol"))
    dates = F.broadcast(dim_date_df.select("date_key", "date"))
    if not with_ids:
        return unpivot_prices(prices).join(companies, "symbol").join(dates, "date")
    present = [m for m in STOCK_METRICS if m in prices.columns]
    wide = (prices.select("symbol", "date", *[F.col(m).cast("double").alias(m) for m in present])
            .join(companies, "symbol").join(dates, "date").withColumn("_all", F.lit(1)))
    long = index_cells(wide, "_all", ["date", "symbol"], present, {1: [1] * len(present)},
                       ["date_key", "company_key"],
                       slices=date_slices(prices, passes) if passes > 1 else None)
    key = F.array(*[F.lit(STOCK_METRIC_KEY[m]) for m in present])
    return _conform(long.select(F.col("id").alias("fact_price_id"), "date_key", "company_key",
                                key[F.col("cell")].alias("stock_metric_key"), "value"), "fact_stock_prices")


class LazyTables(dict):
    """A dict of table builders evaluated on first access (and then kept).

    Keying a fact materialises it, so building only what a caller reads avoids
    paying for tables it never touches.
    """

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __getitem__(self, name):
        if not dict.__contains__(self, name):
            dict.__setitem__(self, name, self._builders[name]())
        return dict.__getitem__(self, name)

    def __contains__(self, name):
        return name in self._builders

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)

    def keys(self):
        return self._builders.keys()

    def items(self):
        return [(k, self[k]) for k in self._builders]

    def values(self):
        return [self[k] for k in self._builders]


def build_star(spark: SparkSession, prices: DataFrame | None,
               statements: dict[str, DataFrame], land: bool = False, passes: int = 1,
               release_prices: bool = False) -> dict[str, DataFrame]:
    """All five dimensions and both facts from Silver prices and statements (lazily).

    Without prices (a source skipped by a tolerant load) the date dimension comes from
    the statements alone and the price fact is left out, so only dependants are skipped.

    With ``land`` each data-derived dimension is written once when first built. A fact is landed
    as its keyed wide rows (``index_cells``), with and without ``land``: reading it unpivots them, so
    marts read Gold instead of re-deriving it. An empty date or company dimension raises: no key
    would be valid.

    The price fact is keyed in ``passes``. With ``release_prices`` (and ``land``) the prices are a landed
    stage that nobody else reads: the price fact is their last reader and deletes them.
    """
    from ..session import materialize, release

    stmts = [statements[n] for n in STATEMENT_ORDER if n in statements]
    # prices may be given as a zero-argument builder, run only if a table needs it
    get_prices = prices if callable(prices) else (lambda: prices)
    t: LazyTables
    landed = {"dim_date", "dim_company"}

    def maybe_land(name, build):
        def landed_build():
            return materialize(build(), name)
        return landed_build if land and name in landed else build

    builders = {
        "dim_date": lambda: dim_date(*[p for p in [get_prices()] if p is not None], *stmts,
                                     check_nonempty=True),
        "dim_company": lambda: dim_company(statements, check_nonempty=True),
        "dim_fin_metric": lambda: dim_fin_metric(spark, statements),
        "dim_fin_statement_type": lambda: dim_fin_statement_type(spark),
        "dim_stock_metric": lambda: dim_stock_metric(spark),
        "fact_finance": lambda: fact_finance(statements, t["dim_company"],
                                             t["dim_fin_metric"], t["dim_date"]),
    }
    def price_fact():
        fact = fact_stock_prices(get_prices(), t["dim_company"], t["dim_date"], passes=passes)
        if land and release_prices:   # dim_date is landed by now
            release(get_prices())
        return fact

    if prices is not None:
        builders["fact_stock_prices"] = price_fact
    t = LazyTables({k: maybe_land(k, b) for k, b in builders.items()})
    return t
