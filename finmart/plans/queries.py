"""Registered queries: one per operator family of the inventory, each reading the
driver tables of ``sf_dir`` end to end (Bronze fixtures → Silver → Gold → marts/ML).

Output rounding (to compare engines by value hash): amounts that are exact decimals keep 6
places, window statistics 6, other statistics 7, coefficients 9 and prices produced by float
recursions 7 significant digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import (boosting, clean, eda, features, forecast, indicators, marts, ml, quality, star,
                         trades)
from ..schemas import FIN_TYPE_KEY, STATEMENT_ORDER
from ..session import materialize, release, scratch_path
from ..sources import files
from ..functions.numeric import round_sig
from ..operators.stats import exact_quantiles_long
from ..sources.fixtures import line_passes, prices_from_events, raw_prices, raw_statements, read_table
from . import etl

R_MONEY, R_STAT, R_ROLL, R_MEAN = 6, 7, 6, 4
SIG_COEF, SIG_PRICE = 9, 7
TICKER, OTHER_TICKER = "Supplier#000000001", "Supplier#000000002"
HORIZON = 30
RANGE = ("1998-01-01", "1998-12-31")


def rnd(df: DataFrame, spec: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in spec.items() if c in df.columns})


def sig(df: DataFrame, columns: list[str], digits: int = SIG_PRICE) -> DataFrame:
    return df.withColumns({c: round_sig(c, digits) for c in columns if c in df.columns})


def coefficients(train: DataFrame) -> DataFrame:
    """Per-symbol OLS, coefficients kept to SIG_COEF significant digits."""
    return sig(ml.fit_ols(train), ["slope", "intercept"], SIG_COEF)


def _money_all(df: DataFrame, digits: int = R_MONEY) -> DataFrame:
    return rnd(df, {f.name: digits for f in df.schema.fields
                    if isinstance(f.dataType, T.DoubleType)})


PRICE_ROUND = {"open": R_MONEY, "high": R_MONEY, "low": R_MONEY, "close": R_MONEY,
               "pct_change": R_ROLL, "daily_return": R_MONEY,
               "volatility_5d": R_ROLL, "volatility_20d": R_ROLL}


def quarter_ends(first_year: int = 1995, last_year: int = 2001) -> list[str]:
    ends = ["03-31", "06-30", "09-30", "12-31"]
    return [f"{y}-{e}" for y in range(first_year, last_year + 1) for e in ends]


# --- layer helpers ------------------------------------------------------------------------

def silver_prices(spark, d) -> DataFrame:
    return etl.silver_prices(raw_prices(spark, d))


def silver_statements(spark, d) -> dict[str, DataFrame]:
    return etl.silver_statements(raw_statements(spark, d))


def landed_silver_prices(spark, d) -> DataFrame:
    """Silver prices landed once; the Bronze bars that were landed for them go."""
    raw = raw_prices(spark, d)
    silver = etl.silver_prices(raw, land=True, passes=line_passes(spark, d))
    release(raw)
    return silver


def gold(spark, d) -> dict[str, DataFrame]:
    """Gold tables over Silver landed once (the ETL's Silver → Gold boundary). The landed prices go when
    the price fact, their last reader, is keyed."""
    silver = etl.silver_statements(raw_statements(spark, d), land=True)
    landed = {}

    def prices():   # landed on first use only (dim_company/dim_fin_metric never need it)
        if "p" not in landed:
            landed["p"] = landed_silver_prices(spark, d)
        return landed["p"]
    return etl.gold_layer(spark, silver, prices, land=True, passes=line_passes(spark, d),
                          release_prices=True)


def split_frame(spark, d) -> DataFrame:
    return features.train_test_split(features.training_frame(silver_prices(spark, d)))


def ols_predictions(spark, d) -> DataFrame:
    split = materialize(split_frame(spark, d), "split")   # the fit and the prediction read it
    coef = coefficients(split.filter(F.col("split") == "train"))
    return ml.predict_ols(split, coef)


def ols_context(spark, d) -> DataFrame:
    prices = materialize(silver_prices(spark, d), "prices")   # context, split and fit read it
    split = features.train_test_split(features.training_frame(prices))
    coef = coefficients(split.filter(F.col("split") == "train"))
    return forecast.forecast_context(prices).join(coef, "symbol")


# --- Phase 1: the minimum slice -------------------------------------------------------------

def q_price_features(spark, d):
    return rnd(silver_prices(spark, d), PRICE_ROUND)


def q_tick_bar_features(spark, d):
    """Second bar shape: event ticks rolled up to daily bars, then the same Silver price path
    (values can be 0, so the zero-divisor guard of pct_change is exercised)."""
    bars = prices_from_events(read_table(spark, d, "events"))
    return rnd(etl.silver_prices(bars), PRICE_ROUND)


def q_mart_prices_wide(spark, d):
    g = gold(spark, d)
    wide = marts.prices_wide(g["fact_stock_prices"], g["dim_company"], g["dim_date"],
                             g["dim_stock_metric"], TICKER)
    return rnd(wide, {**PRICE_ROUND, "volume": R_MONEY})


# --- Phase 2: sources and cleaning ----------------------------------------------------------

def _income_raw(spark, d, land: bool = False):
    """The raw income statement; single-pass queries read the ledger plan directly
    (landing it only pays off when several passes read it)."""
    return raw_statements(spark, d, land)["income_statement"]


def q_raw_scan(spark, d):
    """A vendor file in which a missing amount is None, N/A or NaN, by quarter."""
    raw = _income_raw(spark, d)
    path = scratch_path(spark, "raw-income-csv")
    month = F.substring("fiscalDateEnding", 6, 2)
    missing = F.when(month == "03", "N/A").when(month == "06", "NaN")
    files.write_csv(raw.withColumn("interestExpense", F.coalesce(
        F.col("interestExpense").cast("string"), missing)), path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in raw.schema.fields])
    return _money_all(files.read_csv(spark, path, schema))


def q_malformed_rows(spark, d):
    """Vendor files in which the records of one quarter have a field too many and those of another
    lack their last one; by source: records that loaded, records set aside, an amount of the first."""
    raw, paths, schemas = raw_statements(spark, d), {}, {}
    for name, df in raw.items():
        paths[name] = scratch_path(spark, f"ragged-{name}")
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
        month = F.substring("fiscalDateEnding", 6, 2)
        line = F.when(month == "06", F.concat_ws(",", *cells, F.lit("extra"))) \
            .when(month == "09", F.concat_ws(",", *cells[:-1])).otherwise(F.concat_ws(",", *cells))
        files.write_lines(df.select(line), paths[name], ",".join(df.columns))
        schemas[name] = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    loaded, bad, _ = files.load_checked(spark, paths, schemas)
    aside = files.bad_counts(bad).groupBy("source").agg(F.sum("bad_rows").alias("bad_rows"))
    out = None
    for name, df in loaded.items():
        one = df.agg(F.count(F.lit(1)).alias("good_rows"), F.countDistinct("symbol").alias("symbols"),
                     F.max("fiscalDateEnding").alias("last_quarter")) \
            .select(F.lit(name).alias("source"), "good_rows", "symbols",
                    F.col("last_quarter").cast("string").alias("last_quarter"))
        out = one if out is None else out.unionByName(one)
    return out.join(aside, "source", "left").select(
        "source", "good_rows", F.coalesce("bad_rows", F.lit(0)).cast("long").alias("bad_rows"), "symbols",
        "last_quarter")


def _cells(tables: dict[str, DataFrame]) -> DataFrame:
    """Silver tables as one long table: (table_name, symbol, date, metric_name, value)."""
    out = None
    for name, df in tables.items():
        long = star.unpivot_prices(df) if name == "prices" else star.unpivot_statement(df)
        part = long.select(F.lit(name).alias("table_name"), "symbol", "date", "metric_name",
                           F.round("value", R_ROLL).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def q_silver_roundtrip(spark, d):
    silver = dict(etl.silver_statements(raw_statements(spark, d), land=True).items())   # both writes read it
    silver["prices"] = landed_silver_prices(spark, d)
    path = scratch_path(spark, "silver")
    files.write_silver(silver, path)
    files.write_silver(silver, path)  # second write must replace, not append
    return _cells(files.read_silver(spark, path, list(silver)))


RENAMES = {"fiscalDateEnding": " Fiscal Date Ending ", "reportedCurrency": "Reported Currency",
           "totalRevenue": "Total Revenue", "costOfRevenue": "cost Of Revenue"}


def q_normalize_columns(spark, d):
    raw = _income_raw(spark, d)
    spaced = raw.select(*[F.col(c).alias(RENAMES.get(c, c)) for c in raw.columns])
    return _money_all(clean.normalize_columns(spaced))


def q_drop_empty_columns(spark, d):
    raw = _income_raw(spark, d, land=True)
    return _money_all(clean.drop_empty_columns(clean.normalize_columns(raw)))


def _with_restated_q4(raw: DataFrame) -> DataFrame:
    """The statement plus its Q4 rows sent a second time (exact duplicates)."""
    return raw.unionByName(raw.filter(F.col("fiscalDateEnding").endswith("-12-31")))


def q_dedupe_rows(spark, d):
    return _money_all(clean.dedupe_rows(_with_restated_q4(_income_raw(spark, d))))


def q_bad_dates(spark, d):
    """How many dates the coercion could not read."""
    return clean.null_date_count(q_coerce_dates(spark, d), "order_date")


def q_total_nulls(spark, d):
    raw = raw_statements(spark, d, land=False)["cash_flow"]
    return clean.total_nulls(clean.normalize_columns(raw))


def q_coerce_dates(spark, d):
    orders = read_table(spark, d, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    df = orders.select("o_orderkey", text.alias("order_date"))
    return clean.coerce_dates(df, "order_date")


def q_null_profile(spark, d):
    raw = raw_statements(spark, d, land=False)["balance_sheet"]
    return clean.null_profile(clean.normalize_columns(raw))


def q_impute_median(spark, d):
    """The balance sheet with an integer column whose median need not be an integer."""
    raw = raw_statements(spark, d)["balance_sheet"]
    lines = F.when(F.month(F.col("fiscalDateEnding").cast("date")) != 3,
                   (F.col("commonStock") / 1000).cast("bigint"))
    return _money_all(clean.clean_statement(raw.withColumn("openLines", lines)))


def q_statement_clean(spark, d):
    return _money_all(silver_statements(spark, d)["income_statement"])


def q_validate_table(spark, d):
    bars = raw_prices(spark, d, land=False)
    text = bars.drop("symbol").withColumn(
        "date", F.when(F.dayofweek("date") == 1, F.lit("n/a"))
        .otherwise(F.date_format("date", "yyyy-MM-dd")))
    return clean.validate_table(text, "prices")


def q_cleaning_report(spark, d):
    raw = raw_statements(spark, d)
    out = None
    for name in STATEMENT_ORDER:
        rep = clean.cleaning_report(_with_restated_q4(raw[name]), name)
        out = rep if out is None else out.unionByName(rep)
    return out


def q_profile_tables(spark, d):
    silver = silver_statements(spark, d)
    base = scratch_path(spark, "silver-csv")
    for name, df in silver.items():
        files.write_csv(df, f"{base}/{name}_cleaned.csv")
    tables = files.scan_directory(spark, base)
    out = None
    for name in sorted(tables):
        p = clean.profile(tables[name], name)
        out = p if out is None else out.unionByName(p)
    return out


# --- Phase 3: star schema and quality --------------------------------------------------------

def q_dim_date(spark, d):
    return gold(spark, d)["dim_date"]


def q_dim_company(spark, d):
    return gold(spark, d)["dim_company"]


def q_dim_fin_metric(spark, d):
    return gold(spark, d)["dim_fin_metric"]


def q_finance_unpivot(spark, d):
    long = star.unpivot_statement(silver_statements(spark, d)["income_statement"])
    return _money_all(long)


def q_price_unpivot(spark, d):
    long = star.unpivot_prices(silver_prices(spark, d))
    return long.withColumn("value", F.round("value", R_ROLL))


def q_star_fact_finance(spark, d):
    return _money_all(gold(spark, d)["fact_finance"].drop("year"))


def q_star_fact_prices(spark, d):
    return gold(spark, d)["fact_stock_prices"].drop("year").withColumn("value", F.round("value", R_ROLL))


def q_seed_missing_rows(spark, d):
    """dim_date built from prices only, completed idempotently with statement dates."""
    silver = silver_statements(spark, d)
    target = materialize(star.dim_date(raw_prices(spark, d, land=False)), "target")
    seed = materialize(star.dim_date(*[silver[n] for n in STATEMENT_ORDER]), "seed")
    once = materialize(quality.seed_missing_rows(target, seed, ["date_key"]), "once")
    return quality.seed_missing_rows(once, seed, ["date_key"])


def _gold_with_gap(spark, d):
    """Gold with weekend dates removed from dim_date, so weekend facts become orphans."""
    g = dict(gold(spark, d).items())
    g["dim_date"] = g["dim_date"].filter(~F.col("is_weekend"))
    return g


def q_dq_primary_keys(spark, d):
    tables = {**dict(gold(spark, d).items()), "lineitem": read_table(spark, d, "lineitem")}
    keys = {**quality.PRIMARY_KEYS, "lineitem": ["l_orderkey", "l_linenumber"]}
    return quality.primary_key_report(tables, keys)


def q_dq_foreign_keys(spark, d):
    return quality.foreign_key_report(_gold_with_gap(spark, d))


def q_table_counts(spark, d):
    return quality.table_counts(gold(spark, d))


def q_gold_roundtrip(spark, d):
    """Both facts written whole, then again without the years from 2000 on: those must go."""
    g = gold(spark, d)
    base = scratch_path(spark, "gold")
    out = None
    for name, key, metric in (("fact_finance", "fact_finance_id", "metric_key"),
                              ("fact_stock_prices", "fact_price_id", "stock_metric_key")):
        files.write_gold(g[name], name, base, dealt=True)
        files.write_gold(g[name].filter("date_key < 20000101"), name, base, dealt=True)
        part = files.read_gold(spark, base, [name])[name].select(
            F.lit(name).alias("table_name"), F.col(key).alias("row_id"), "date_key", "company_key",
            F.col(metric).alias("metric_key"), F.round("value", R_ROLL).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def q_warehouse_refresh(spark, d):
    """All seven tables refreshed twice in the catalog; their row counts read back from it."""
    g = gold(spark, d)
    db = "finmart_wh"
    files.create_star_tables(spark, db, scratch_path(spark, "warehouse"))
    tables = {}
    for name, df in g.items():
        files.refresh_table(spark, df, f"{db}.{name}", name, dealt=True)
        tables[name] = files.refresh_table(spark, df, f"{db}.{name}", name, dealt=True)
    return quality.table_counts(tables)


def q_reconcile_warehouse(spark, d):
    """Gold against the catalog's tables by row fingerprints, facts by year."""
    g = dict(gold(spark, d).items())
    db = "finmart_rec"
    files.create_star_tables(spark, db, scratch_path(spark, "warehouse"))
    held = {name: files.refresh_table(spark, df, f"{db}.{name}", name, dealt=True).select(*df.columns)
            for name, df in g.items()}
    return quality.reconcile(g, held)


def q_enforced_load(spark, d):
    """Three batches for the statement facts: every row again (refused: the keys are held), new keys
    for unknown companies (refused: no parent), new keys (accepted). One row a batch."""
    from pyspark.errors import PySparkException

    g = gold(spark, d)
    db, name = "finmart_load", "fact_finance"
    files.create_star_tables(spark, db, scratch_path(spark, "warehouse"))
    fact = g[name]
    files.refresh_table(spark, fact, f"{db}.{name}", name, dealt=True)
    new_key = F.col("fact_finance_id") + fact.agg(F.max("fact_finance_id")).first()[0]
    batches = {"1 repeated": fact, "2 orphans": fact.withColumns(
        {"fact_finance_id": new_key, "company_key": F.col("company_key") + 1_000_000}),
        "3 new": fact.withColumn("fact_finance_id", new_key)}
    out = None
    for label, batch in batches.items():
        try:
            loaded = files.load_rows(spark, batch, f"{db}.{name}", name, g)["rows"]
        except PySparkException:
            loaded = 0
        row = spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("rows_after")).select(
            F.lit(label).alias("batch"), F.lit(loaded).cast("long").alias("rows_loaded"), "rows_after")
        row = materialize(row, "load")   # the count as it is now
        out = row if out is None else out.unionByName(row)
    return out


# --- Phase 4: marts and EDA ------------------------------------------------------------------

def _long(spark, d, ticker=TICKER, statement="income_statement"):
    g = gold(spark, d)
    return marts.statement_long(g["fact_finance"], g["dim_company"], g["dim_date"],
                                g["dim_fin_metric"], ticker, FIN_TYPE_KEY[statement])


def q_mart_price_range(spark, d):
    g = gold(spark, d)
    wide = marts.prices_wide(g["fact_stock_prices"], g["dim_company"], g["dim_date"],
                             g["dim_stock_metric"], TICKER, *RANGE)
    return rnd(marts.price_range(wide, *RANGE), {**PRICE_ROUND, "volume": R_MONEY})


def q_mart_statement_long(spark, d):
    return _money_all(_long(spark, d, OTHER_TICKER, "income_statement"))


def q_mart_statement_matrix(spark, d):
    return _money_all(marts.statement_matrix(_long(spark, d), quarter_ends()))


def q_metric_trend(spark, d):
    return _money_all(marts.metric_trend(_long(spark, d, TICKER, "balance_sheet")))


def q_metric_choice(spark, d):
    """The trend of metrics that the user names."""
    return _money_all(marts.metric_trend(_long(spark, d, OTHER_TICKER, "cash_flow"),
                                         ["netincome", "operatingcashflow"]))


def q_distinct_metrics(spark, d):
    return marts.distinct_values(_long(spark, d, TICKER, "cash_flow"), "metric_name")


def q_date_bounds(spark, d):
    return marts.date_bounds(silver_prices(spark, d), by="symbol")


def q_latest_kpis(spark, d):
    k = marts.latest_kpis(silver_prices(spark, d))
    return rnd(k, {"close": R_MONEY, "open": R_MONEY, "high": R_MONEY, "low": R_MONEY,
                   "prev_close": R_MONEY, "change": R_MONEY, "change_pct": R_STAT})


def q_price_volume_series(spark, d):
    return marts.price_volume_series(silver_prices(spark, d))


def q_revenue_series(spark, d):
    return _money_all(marts.revenue_series(silver_statements(spark, d)["income_statement"]))


def q_cashflow_series(spark, d):
    return _money_all(marts.cashflow_series(silver_statements(spark, d)["cash_flow"]))


def q_assets_series(spark, d):
    return _money_all(marts.assets_series(silver_statements(spark, d)["balance_sheet"]))


def q_cost_structure(spark, d):
    raw = clean.normalize_columns(_income_raw(spark, d))
    return rnd(eda.cost_structure(raw), {"avg_value": R_MONEY, "share_pct": R_STAT})


def q_correlation_matrix(spark, d):
    bs = silver_statements(spark, d)["balance_sheet"]
    return rnd(eda.correlation_matrix(bs), {"corr": R_STAT})


def q_wide_correlation(spark, d):
    """The balance sheet's correlations from one scan of matrix products."""
    bs = materialize(silver_statements(spark, d)["balance_sheet"], "sheet")
    return rnd(eda.wide_correlation_matrix(bs), {"corr": R_STAT})


# --- Phase 5: ML, forecast, scenarios ---------------------------------------------------------

def q_training_frame(spark, d):
    return rnd(features.training_frame(silver_prices(spark, d)),
               {**PRICE_ROUND, "target": R_ROLL})


def q_train_test_split(spark, d):
    return rnd(split_frame(spark, d), {**PRICE_ROUND, "target": R_ROLL})


def q_price_reconstruction(spark, d):
    pred = ols_predictions(spark, d).filter(F.col("split") == "test")
    out = pred.select("symbol", "date", "close",
                      (F.col("close") * (1 + F.col("prediction"))).alias("predicted_price"),
                      (F.col("close") * (1 + F.col("target"))).alias("actual_price"))
    return sig(rnd(out, {"close": R_MONEY}), ["predicted_price", "actual_price"], 10)


METRIC_ROUND = {"mae": R_STAT, "rmse": R_STAT, "r2_train": R_STAT - 3, "r2_test": R_STAT - 3,
                "da": R_STAT, "score": R_STAT - 3, "gap": R_STAT - 3}


def q_model_metrics(spark, d):
    return rnd(ml.split_metrics(ols_predictions(spark, d), ["symbol"]), METRIC_ROUND)


def q_model_ranking(spark, d):
    models = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(k).alias("model_ordinal"),
                                p.alias("p")) for k, (name, p) in enumerate(
        [("OLS pct_change", F.col("prediction")), ("Zero return", F.lit(0.0))], start=1)])
    pred = ols_predictions(spark, d).withColumn("m", F.explode(models))
    pred = pred.select("symbol", "split", "target", "m.model", "m.model_ordinal",
                       F.col("m.p").alias("prediction"))
    metrics = ml.split_metrics(pred, ["symbol", "model", "model_ordinal"])
    return rnd(ml.rank_models(metrics, "symbol"), METRIC_ROUND)


def q_ml_compare(spark, d):
    ranked, _ = ml.compare_models(split_frame(spark, d))
    return ranked


def q_model_reload(spark, d):
    """A fitted model saved, loaded by a session of its own, and compared on every row."""
    from pyspark.ml.regression import LinearRegression

    split = materialize(split_frame(spark, d), "split")
    model = LinearRegression(featuresCol="features", labelCol="target", regParam=0.0, solver="normal") \
        .fit(ml.assemble(split.filter(F.col("split") == "train")))
    path = scratch_path(spark, "model")
    ml.save_model(model, path)
    return ml.compare_predictions(split, model, ml.load_model(spark.newSession(), path))


def _moves(spark, d):
    return silver_prices(spark, d)


def q_direction_metrics(spark, d):
    """Direction of the day's move told from the move of the day before, by walk-forward fold."""
    frame = boosting.date_folds(boosting.move_frame(_moves(spark, d)))
    scored = materialize(frame.filter("block >= 1").select(
        F.col("block").alias("fold"), "up", F.round("pct_change", R_ROLL).alias("score")), "scored")
    return rnd(boosting.direction_metrics(scored, threshold=0.0),
               {c: R_STAT for c in ("accuracy", "precision", "recall", "f1", "auc")})


def q_boosted_moves(spark, d):
    """Boosted direction and price models: test metrics of every walk-forward fold."""
    stored = boosting.walk_forward_predictions(_moves(spark, d))
    return boosting.direction_metrics(stored).join(boosting.price_metrics(stored).drop("n"), "fold")


def q_split_series_features(spark, d):
    """The price features with every series cut into pieces of 100 bars."""
    bars = clean.ensure_symbol(clean.coerce_dates(clean.preprocess_raw(raw_prices(spark, d)), "date"), TICKER)
    return rnd(features.add_price_features_in_pieces(bars, rows=100), PRICE_ROUND)


def q_split_moving_averages(spark, d):
    from ..operators import series
    return rnd(series.in_pieces(raw_prices(spark, d), indicators.moving_averages, halo=20, rows=100),
               {"close": R_MONEY, "daily_return": R_MONEY, "ma_5": R_MEAN, "ma_20": R_MEAN})


def q_ml_linear_fit(spark, d):
    """Spark ML least squares on one feature, over the pooled training rows."""
    from pyspark.ml.regression import LinearRegression

    split = materialize(split_frame(spark, d).filter(F.col("split") == "train"), "train")
    model = LinearRegression(featuresCol="features", labelCol="target", regParam=0.0,
                             solver="normal").fit(ml.assemble(split, ["pct_change"]))
    out = split.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.lit(float(model.coefficients[0])).alias("slope"), F.lit(float(model.intercept)).alias("intercept"))
    return sig(out, ["slope", "intercept"], 6)


def q_ml_forecast(spark, d):
    """Pooled 9-feature Spark ML linear model, then the model-agnostic recursive forecast; a
    path that leaves the finite range is NULL from there on and says so."""
    from pyspark.ml.regression import LinearRegression

    prices = materialize(silver_prices(spark, d), "prices")
    split = materialize(features.train_test_split(features.training_frame(prices)), "split")
    est = LinearRegression(featuresCol="features", labelCol="target", regParam=0.0,
                           solver="normal")
    model = est.fit(ml.assemble(split.filter(F.col("split") == "train")))
    bounds = forecast.return_bounds(split.filter(F.col("split") == "train"))
    path = forecast.forecast_with_model(forecast.forecast_context(prices), model, HORIZON, bounds=bounds)
    return forecast.bounded(path)


QUANTILES = [0.05, 0.25, 0.5, 0.75, 0.95]


def q_return_quantiles(spark, d):
    """Exact quantiles of the daily return for every symbol and month."""
    group = F.struct("symbol", F.date_format("date", "yyyy-MM").alias("month")).alias("g")
    long = silver_prices(spark, d).select(group, F.round("pct_change", R_ROLL).alias("value"))
    q = exact_quantiles_long(long, "g", "value", QUANTILES, many_groups=True)
    wide = q.groupBy("g").agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(f"p{round(100 * p)}")
                                for p in QUANTILES])
    return rnd(wide.select("g.symbol", "g.month", *wide.columns[1:]), {c: R_ROLL + 3 for c in wide.columns[1:]})


def q_forecast_context(spark, d):
    ctx = forecast.forecast_context(silver_prices(spark, d))
    return rnd(ctx, {**PRICE_ROUND, "avg_volatility_5d": R_STAT, "avg_volatility_20d": R_STAT,
                     "avg_volume": R_STAT, "daily_volatility": R_STAT})


def _forecast(spark, d):
    ctx = ols_context(spark, d)
    return ctx, forecast.ols_forecast(ctx, HORIZON)


def q_recursive_forecast(spark, d):
    _, f = _forecast(spark, d)
    return sig(f, ["predicted_price"])


def q_recommend_basic(spark, d):
    ctx, f = _forecast(spark, d)
    rec = forecast.recommend_basic(f, ctx)
    return sig(rec, ["current_price", "target_price", "highest_price", "lowest_price",
                     "change_percent"])


# --- Phase 6: indicators ----------------------------------------------------------------------

def q_moving_averages(spark, d):
    return rnd(indicators.moving_averages(raw_prices(spark, d, land=False)),
               {"close": R_MONEY, "daily_return": R_MONEY, "ma_5": R_MEAN, "ma_20": R_MEAN})


def q_oscillators(spark, d):
    return rnd(indicators.oscillators(raw_prices(spark, d, land=False)),
               {c: R_MEAN for c in ("rsi", "atr", "macd", "macd_signal")})


def q_price_bands(spark, d):
    return rnd(indicators.bands(raw_prices(spark, d, land=False)),
               {c: R_MEAN for c in ("middle", "upper", "lower", "stoch_k", "stoch_d")})


def q_candles(spark, d):
    return rnd(indicators.candles(raw_prices(spark, d, land=False)),
               {"close_lag_1": R_MONEY, "close_lag_2": R_MONEY, "close_lag_3": R_MONEY,
                "volume_ma_5": R_MEAN, "volume_ratio": R_MEAN})


def q_guarded_features(spark, d):
    cols = ["pct_change", "daily_return", "volatility_5d", "volatility_20d"]
    lagged = indicators.guarded(silver_prices(spark, d), cols)
    return rnd(lagged.select("symbol", "date", *cols), PRICE_ROUND)


def q_walk_forward(spark, d):
    frame = features.training_frame(silver_prices(spark, d))
    return rnd(indicators.walk_forward(frame), {"mae": R_ROLL, "rmse": R_ROLL})


def _crossover_positions(spark, d):
    bars = raw_prices(spark, d, land=False)
    return trades.positions(bars.withColumn("up", trades.crossover()), F.col("up"))


def q_signal_trades(spark, d):
    """Every trade of the moving-average crossover, entered and left at the next open."""
    return rnd(trades.trades(_crossover_positions(spark, d)),
               {"entry_price": R_MONEY, "exit_price": R_MONEY, "trade_return": R_ROLL})


def q_signal_statistics(spark, d):
    """Win rate, profit factor and Sharpe ratio of these trades by symbol."""
    return rnd(trades.trade_statistics(materialize(_crossover_positions(spark, d), "positions")),
               {c: R_ROLL for c in ("win_rate", "mean_return", "profit_factor", "sharpe")})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
