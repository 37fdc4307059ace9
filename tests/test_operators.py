"""Unit tests on tiny literal frames: nulls, ties, constants, empty and edge cases."""

import datetime as dt

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.functions import dates as D
from finmart.functions.numeric import round_sig
from finmart.operators import clean, eda, features, forecast, indicators, keys, marts, quality, star
from finmart.sources import files
from finmart.operators.stats import exact_quantiles_long
from finmart.schemas import STATEMENT_TYPES, STOCK_METRICS


def d(s):
    return dt.date.fromisoformat(s)


# --- cleaning ---------------------------------------------------------------------------

def test_normalize_columns_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], [" Total Revenue ", "netIncome"])
    assert clean.normalize_columns(df).columns == ["total_revenue", "netincome"]
    bad = spark.createDataFrame([(1, 2)], ["A b", "a_b"])
    with pytest.raises(ValueError):
        clean.normalize_columns(bad)


def test_drop_empty_and_dedupe(spark):
    schema = "a int, b double, c string"
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, None, None)], schema)
    out = clean.dedupe_rows(clean.drop_empty_columns(df))
    assert out.columns == ["a", "c"]
    assert sorted(out.collect(), key=lambda r: r.a) == [(1, "x"), (2, None)]


def test_coerce_dates_bad_text_is_null(spark):
    df = spark.createDataFrame([("2020-01-31",), ("garbage",), (None,)], "date string")
    out = clean.coerce_dates(df, "date")
    assert [r.date for r in out.collect()] == [d("2020-01-31"), None, None]
    assert clean.null_date_count(out).first()[0] == 2


def test_unify_statement_date_fallbacks(spark):
    a = spark.createDataFrame([("2020-03-31", "x")], "fiscaldateending string, date string")
    assert clean.unify_statement_date(a).first().date == d("2020-03-31")
    b = spark.createDataFrame([("2020-06-30",)], "date string")
    assert clean.unify_statement_date(b).first().date == d("2020-06-30")
    c = spark.createDataFrame([(1,)], "v int")
    assert clean.unify_statement_date(c).first().date is None


def test_median_even_count_and_imputation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, None), (10.0, 7.0), (None, 9.0)],
                               "x double, y double")
    med = clean.column_medians(df, ["x", "y"])
    assert med == {"x": 2.0, "y": 7.0}
    even = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert clean.column_medians(even, ["x"]) == {"x": 2.5}
    filled = clean.impute_median(df)
    assert [r.x for r in filled.collect()] == [1.0, 2.0, 10.0, 2.0]
    whole = spark.createDataFrame([(10,), (None,), (13,)], "n int")
    assert sorted(r.n for r in clean.impute_median(whole).collect()) == [10.0, 11.5, 13.0]


def test_distributed_quantiles_match_aggregate(spark):
    rows = [(g, float(v)) for g in ("a", "b") for v in [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]]
    long = spark.createDataFrame(rows, "g string, v double")
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    dist = {(r.g, r.p): r.q for r in exact_quantiles_long(long, "g", "v", probs).collect()}
    agg = long.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()
    for r in agg:
        for p, q in zip(probs, r.q):
            assert dist[(r.g, p)] == pytest.approx(q, abs=1e-12)


def test_ensure_symbol_and_validate(spark):
    df = spark.createDataFrame([("2020-01-02", "T")], "date string, ticker string")
    assert clean.ensure_symbol(df).first().symbol == "T"
    out = clean.validate_table(spark.createDataFrame([("2020-01-02",)], "date string"), "p")
    assert out.first().symbol == "GOOGL" and out.first().date == d("2020-01-02")
    with pytest.raises(ValueError):
        clean.validate_table(spark.createDataFrame([(1,)], "v int"), "p")


def test_null_profile_top_k_and_ties(spark):
    df = spark.createDataFrame([(None, None, 1, None), (None, None, 2, 1)],
                               "b int, a int, c int, d int")
    out = clean.null_profile(df, top=2).collect()
    assert [(r.column_name, r.null_count, r.null_pct) for r in out] == [("a", 2, 100.0),
                                                                        ("b", 2, 100.0)]


def test_cleaning_report(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None)], "a int, b double")
    r = clean.cleaning_report(df, "t").first()
    assert (r.rows_before, r.rows_after, r.duplicates_removed, r.cols_after,
            r.empty_columns_dropped) == (3, 2, 1, 1, 1)


# --- price features -----------------------------------------------------------------------

def _prices(spark, rows):
    return spark.createDataFrame(rows, "symbol string, date date, close double")


def test_pct_change_forward_fills_null_close(spark):
    rows = [("A", d("2020-01-01"), 10.0), ("A", d("2020-01-02"), None),
            ("A", d("2020-01-03"), 11.0), ("B", d("2020-01-02"), 5.0)]
    out = {(r.symbol, r.date): r for r in features.add_price_features(_prices(spark, rows)).collect()}
    assert out[("A", d("2020-01-01"))].pct_change is None
    assert out[("A", d("2020-01-02"))].pct_change == 0.0          # gap → 0, not NULL
    assert out[("A", d("2020-01-03"))].pct_change == pytest.approx(0.1)
    assert out[("A", d("2020-01-03"))].daily_return is None        # no fill for the diff
    assert out[("B", d("2020-01-02"))].pct_change is None          # single-row symbol


def test_zero_divisor_is_null(spark):
    rows = [("A", d("2020-01-01"), 0.0), ("A", d("2020-01-02"), 5.0)]
    out = features.add_price_features(_prices(spark, rows)).orderBy("date").collect()
    assert out[1].pct_change is None


def test_rolling_volatility_needs_full_window(spark):
    closes = [100, 101, 99, 102, 104, 103, 105]
    rows = [("A", d("2020-01-01") + dt.timedelta(days=i), float(c)) for i, c in enumerate(closes)]
    out = features.add_price_features(_prices(spark, rows)).orderBy("date").collect()
    pct = [None] + [closes[i] / closes[i - 1] - 1 for i in range(1, len(closes))]
    assert [r.volatility_5d is None for r in out] == [True] * 5 + [False] * 2
    import statistics
    assert out[5].volatility_5d == pytest.approx(statistics.stdev(pct[1:6]))
    assert all(r.volatility_20d is None for r in out)


def test_interleaved_symbols_do_not_mix(spark):
    rows = [("A", d("2020-01-01"), 1.0), ("B", d("2020-01-01"), 100.0),
            ("A", d("2020-01-02"), 2.0), ("B", d("2020-01-02"), 50.0)]
    out = {(r.symbol, r.date): r.pct_change
           for r in features.add_price_features(_prices(spark, rows)).collect()}
    assert out[("A", d("2020-01-02"))] == 1.0 and out[("B", d("2020-01-02"))] == -0.5


def test_train_test_split_floor(spark):
    rows = [("A", d("2020-01-01") + dt.timedelta(days=i), float(i)) for i in range(7)]
    df = spark.createDataFrame(rows, "symbol string, date date, v double")
    out = features.train_test_split(df).orderBy("date").collect()
    assert [r.split for r in out] == ["train"] * 5 + ["test"] * 2   # floor(0.8·7) = 5


# --- dates ----------------------------------------------------------------------------------

def test_date_functions(spark):
    df = spark.createDataFrame([(d("2025-09-30"),)], "d date")
    r = df.select(D.date_key("d").alias("k"), D.month_name("d").alias("m"),
                  D.quarter_label("d").alias("q"), D.iso_weekday("d").alias("w"),
                  D.is_weekend("d").alias("we"), D.quarter_end(F.lit("2025-08-15")).alias("qe")
                  ).first()
    assert (r.k, r.m, r.q, r.w, r.we, r.qe) == (20250930, "September", "Q3", 2, False,
                                               d("2025-09-30"))


@pytest.mark.parametrize("start,expected", [("2024-01-04", "2024-01-05"),   # Thu → Fri
                                            ("2024-01-05", "2024-01-08"),   # Fri → Mon
                                            ("2024-01-06", "2024-01-08"),   # Sat → Mon
                                            ("2024-01-07", "2024-01-08")])  # Sun → Mon
def test_next_business_day(spark, start, expected):
    df = spark.createDataFrame([(d(start),)], "d date")
    assert df.select(D.next_business_day("d")).first()[0] == d(expected)


# --- keys -------------------------------------------------------------------------------------

def test_dense_index_is_a_permutation_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"),
                                     (F.col("id") % 3).alias("g"))
    out = keys.dense_index(df, ["g", F.col("v").desc()], "k")
    got = [(r.g, r.v, r.k) for r in out.collect()]
    expected = sorted(((g, v) for g, v, _ in got), key=lambda t: (t[0], -t[1]))
    assert sorted(got, key=lambda t: t[2]) == [(g, v, i + 1) for i, (g, v) in enumerate(expected)]


# --- star schema -----------------------------------------------------------------------------

def _statements(spark):
    bs = spark.createDataFrame(
        [("B", d("2020-03-31"), 1.0, 2.0), ("A", d("2020-03-31"), 3.0, 4.0),
         ("A", d("2019-12-31"), None, 5.0)],
        "symbol string, date date, totalassets double, netincome double")
    inc = spark.createDataFrame(
        [("C", d("2020-06-30"), 7.0, 8.0)],
        "symbol string, date date, totalrevenue double, netincome double")
    return {"balance_sheet": bs, "income_statement": inc}


def test_dims_and_fact_finance(spark):
    st = _statements(spark)
    dm = star.dim_fin_metric(spark, st).collect()
    assert [(r.metric_key, r.metric_name, r.metric_group) for r in dm] == [
        (1, "totalassets", "balance_sheet"), (2, "netincome", "balance_sheet"),
        (3, "totalrevenue", "income_statement")]
    dc = star.dim_company(st).orderBy("company_key").collect()
    assert [r.ticker for r in dc] == ["A", "B", "C"]
    dd = star.dim_date(*st.values())
    fact = star.fact_finance(st, star.dim_company(st), star.dim_fin_metric(spark, st), dd)
    rows = fact.orderBy("fact_finance_id").collect()
    assert len(rows) == 7    # one NULL value dropped
    # statement, column, date desc, symbol; netincome of statement 2 keeps metric key 2
    assert [(r.fin_type_key, r.metric_key, r.date_key) for r in rows][:3] == [
        (1, 1, 20200331), (1, 1, 20200331), (1, 2, 20200331)]
    assert rows[-1].metric_key == 2 and rows[-1].fin_type_key == 2


def test_constant_dims(spark):
    assert [tuple(r) for r in star.dim_fin_statement_type(spark).collect()] == STATEMENT_TYPES
    assert [r.metric_name for r in star.dim_stock_metric(spark).orderBy("stock_metric_key")
            .collect()] == STOCK_METRICS


def test_seed_missing_rows_is_idempotent(spark):
    full = star.dim_stock_metric(spark)
    target = full.filter(~F.col("stock_metric_key").isin(3, 7))
    once = quality.seed_missing_rows(target, full, ["stock_metric_key"])
    twice = quality.seed_missing_rows(once, full, ["stock_metric_key"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, full.collect()))


def test_quality_reports(spark):
    dims = {"dim_stock_metric": star.dim_stock_metric(spark)}
    fact = spark.createDataFrame([(1, 1), (2, 1), (3, 99)], "fact_price_id int, stock_metric_key int")
    t = {**dims, "fact_stock_prices": fact}
    fk = quality.foreign_key_report(t, [("fact_stock_prices", "stock_metric_key",
                                         "dim_stock_metric", "stock_metric_key")]).first()
    assert fk.orphan_rows == 1
    pk = quality.primary_key_report(t, {"fact_stock_prices": ["stock_metric_key"]}).first()
    assert (pk.duplicate_keys, pk.rows_in_duplicates) == (1, 2)


# --- marts ------------------------------------------------------------------------------------

def test_prices_wide_unknown_ticker_is_empty_and_duplicates_average(spark):
    dc = spark.createDataFrame([(1, "A")], "company_key int, ticker string")
    dd = spark.createDataFrame([(20200101, d("2020-01-01"))], "date_key int, date date")
    fact = spark.createDataFrame([(1, 20200101, 1, 4, 10.0), (2, 20200101, 1, 4, 20.0)],
                                 "fact_price_id int, date_key int, company_key int, "
                                 "stock_metric_key int, value double")
    sm = star.dim_stock_metric(spark)
    assert marts.prices_wide(fact, dc, dd, sm, "ZZZ").count() == 0
    r = marts.prices_wide(fact, dc, dd, sm, "A").first()
    assert r.close == 15.0 and r.open is None


def test_statement_matrix_duplicate_is_error(spark):
    long = spark.createDataFrame([("m", d("2020-03-31"), 1.0), ("m", d("2020-03-31"), 2.0)],
                                 "metric_name string, date date, value double")
    with pytest.raises(Exception, match="duplicate cell"):
        marts.statement_matrix(long, ["2020-03-31"]).collect()


# --- EDA --------------------------------------------------------------------------------------

def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)],
                               "a double, b double, c double")
    out = {(r.col_a, r.col_b): r.corr for r in eda.correlation_matrix(df).collect()}
    assert len(out) == 9
    assert out[("a", "c")] is None and out[("c", "c")] is None
    assert out[("a", "b")] == pytest.approx(out[("b", "a")])
    assert out[("a", "a")] == pytest.approx(1.0)
    one = spark.createDataFrame([(1.0,)], "a double")
    assert eda.correlation_matrix(one).count() == 0


def test_cost_structure_shares_sum_to_100(spark):
    df = spark.createDataFrame([(10.0, 5.0, None), (30.0, 15.0, 5.0)],
                               "costofrevenue double, operatingexpenses double, "
                               "interestexpense double")
    out = eda.cost_structure(df).collect()
    assert [r.avg_value for r in out] == [20.0, 10.0, 5.0]
    assert sum(r.share_pct for r in out) == pytest.approx(100.0)


# --- forecast ------------------------------------------------------------------

def _ctx(spark, close=100.0):
    return spark.createDataFrame(
        [("A", d("2024-01-05"), 99.0, 101.0, 98.0, close, 1000, 0.01, 1.0, 0.02, 0.03,
          0.02, 0.03, 1200.0, 0.02)],
        "symbol string, date date, open double, high double, low double, close double, "
        "volume long, pct_change double, daily_return double, volatility_5d double, "
        "volatility_20d double, avg_volatility_5d double, avg_volatility_20d double, "
        "avg_volume double, daily_volatility double")


def test_recursive_forecast_matches_python_loop(spark):
    coef = {"close": 0.0001, "pct_change": 0.5, "volume": 1e-6}
    out = forecast.recursive_forecast(_ctx(spark), 6, coef, 0.001).orderBy("step").collect()
    close, pct, date, vol = 100.0, 0.01, d("2024-01-05"), 1000.0
    for r in out:
        ret = 0.001 + 0.0001 * close + 0.5 * pct + 1e-6 * vol
        pred = close * (1 + ret)
        pct, close, vol = (pred - close) / close, pred, 1200.0
        date = date + dt.timedelta(days=1)
        while date.weekday() >= 5:
            date += dt.timedelta(days=1)
        assert r.predicted_price == pytest.approx(pred, rel=1e-12) and r.date == date
    assert out[0].date == d("2024-01-08")     # Friday start → Monday


@pytest.mark.parametrize("final,status", [(102.0, "UP_SLIGHT"), (102.0001, "UP_STRONG"),
                                          (100.5, "FLAT"), (100.6, "UP_SLIGHT"),
                                          (98.0, "DOWN_SLIGHT"), (97.9, "DOWN_STRONG"),
                                          (99.5, "FLAT"), (99.4, "DOWN_SLIGHT")])
def test_basic_recommendation_strict_thresholds(spark, final, status):
    """Exactly +2 % / +0.5 % (and the negatives) fall into the milder band."""
    fc = spark.createDataFrame([("A", 1, final)], "symbol string, step int, predicted_price double")
    ctx = spark.createDataFrame([("A", 100.0)], "symbol string, close double")
    assert forecast.recommend_basic(fc, ctx).first().status == status


def test_round_sig(spark):
    df = spark.createDataFrame([(123456789.987,), (-0.000123456789,), (None,)], "x double")
    out = [r[0] for r in df.select(round_sig("x", 4)).collect()]
    assert out == [123500000.0, -0.0001235, None]


def test_model_forecast_equals_linear_aggregate_path(spark):
    """The per-step transform path and the in-row aggregate agree for a linear model."""
    from pyspark.ml.regression import LinearRegression
    from finmart.operators.ml import assemble, linear_coefficients
    from finmart.schemas import FEATURES
    import random
    rnd = random.Random(3)
    rows = [tuple(rnd.uniform(0.5, 2.0) for _ in FEATURES) + (rnd.uniform(-0.01, 0.01),)
            for _ in range(60)]
    train = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in FEATURES) + ", target double")
    model = LinearRegression(featuresCol="features", labelCol="target", solver="normal").fit(
        assemble(train))
    ctx = _ctx(spark)
    coefs, icpt = linear_coefficients(model)
    a = forecast.recursive_forecast(ctx, 12, coefs, icpt).orderBy("step").collect()
    b = forecast.model_forecast(ctx, model, 12, checkpoint_every=5).orderBy("step").collect()
    assert [r.date for r in a] == [r.date for r in b]
    for x, y in zip(a, b):
        assert x.predicted_price == pytest.approx(y.predicted_price, rel=1e-9)


def test_model_forecast_with_forest(spark):
    from pyspark.ml.regression import RandomForestRegressor
    from finmart.operators.ml import assemble
    from finmart.schemas import FEATURES
    rows = [tuple(float(i + j) for j in range(len(FEATURES))) + (0.001 * (i % 5),)
            for i in range(40)]
    train = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in FEATURES) + ", target double")
    model = RandomForestRegressor(featuresCol="features", labelCol="target", numTrees=3,
                                  maxDepth=3, seed=42).fit(assemble(train))
    out = forecast.model_forecast(_ctx(spark), model, 4).collect()
    assert sorted(r.step for r in out) == [1, 2, 3, 4]
    assert all(r.predicted_price > 0 for r in out)


# --- sources / persistence -----------------------------------------------------------------

def test_strict_and_tolerant_loads(spark, tmp_path):
    from pyspark.errors import AnalysisException
    from finmart.sources import files
    good = str(tmp_path / "bs")
    files.write_csv(spark.createDataFrame([("2020-03-31", None, 1.5)],
                                          "fiscalDateEnding string, x double, y double"), good)
    paths = {"balance_sheet": good, "prices": str(tmp_path / "missing.csv")}
    loaded, failed = files.load_sources(spark, paths, required=False)
    assert list(loaded) == ["balance_sheet"] and failed == ["prices"]
    row = loaded["balance_sheet"].first()
    assert row.x is None and row.y == 1.5          # the "None" token reads as NULL
    with pytest.raises(AnalysisException):
        files.load_sources(spark, paths, required=True)


def test_scan_directory_coerces_first_column(spark, tmp_path):
    from finmart.sources import files
    files.write_csv(spark.createDataFrame([("2020-03-31", 1.0), ("bad", 2.0)], "d string, v double"),
                    str(tmp_path / "a_cleaned.csv"))
    tables = files.scan_directory(spark, str(tmp_path))
    assert list(tables) == ["a_cleaned_raw"]
    assert sorted(r.d is None for r in tables["a_cleaned_raw"].collect()) == [False, True]


def test_gold_roundtrip_overwrites(spark, tmp_path):
    from finmart.sources import files
    fact = spark.createDataFrame([(1, 20200101, 1, 4, 1.0), (2, 20210101, 1, 4, 2.0)],
                                 "fact_price_id int, date_key int, company_key int, "
                                 "stock_metric_key int, value double")
    for _ in range(2):
        files.write_gold(fact, "fact_stock_prices", str(tmp_path))
    back = files.read_gold(spark, str(tmp_path), ["fact_stock_prices"])["fact_stock_prices"]
    assert back.count() == 2 and back.columns == fact.columns


def test_compare_models_ranks_and_persists(spark, tmp_path):
    from pyspark.ml.regression import LinearRegression, LinearRegressionModel
    from finmart.operators import ml
    from finmart.schemas import FEATURES
    rows = [tuple(float((i * (j + 3)) % 17) for j in range(len(FEATURES)))
            + (0.01 * ((i % 7) - 3), "train" if i < 40 else "test") for i in range(50)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in FEATURES)
                               + ", target double, split string")
    cands = [("OLS", LinearRegression(featuresCol="features", labelCol="target")),
             ("Ridge", LinearRegression(featuresCol="features", labelCol="target", regParam=10.0))]
    ranked, best = ml.compare_models(df, cands, save_path=str(tmp_path / "best"))
    rows = ranked.orderBy("rank").collect()
    assert [r.rank for r in rows] == [1, 2] and rows[0].score <= rows[1].score
    assert LinearRegressionModel.load(str(tmp_path / "best")).coefficients == best.coefficients


def test_distributed_median_with_hot_value(spark):
    """A third of the rows share one value; the pre-aggregated pick still matches median."""
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 37 % 1000).cast("double"))
        .alias("x"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id").cast("double")).alias("y"))
    exact = df.agg(F.median("x"), F.median("y")).first()
    got = clean.column_medians(df, ["x", "y"])
    assert got == {"x": exact[0], "y": exact[1]}


def test_empty_dimensions_raise_when_landed(spark):
    empty = spark.createDataFrame([], "symbol string, date date, totalassets double")
    prices = spark.createDataFrame([], "symbol string, date date, close double")
    g = star.build_star(spark, prices, {"balance_sheet": empty}, land=True)
    with pytest.raises(ValueError):
        g["dim_date"]
    with pytest.raises(ValueError):
        g["dim_company"]


# --- sources ------------------------------------------------------------------------------------

def test_csv_missing_tokens_and_inference(spark, tmp_path):
    (tmp_path / "t.csv").write_text("d,a,b,c\n2020-01-31,1,N/A,x\n2020-02-29,NaN,2.5,null\nNone,3,nan,NA\n")
    df = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert [t for _, t in df.dtypes] == ["date", "bigint", "double", "string"]
    assert [tuple(r)[1:] for r in df.collect()] == [(1, None, "x"), (None, 2.5, None), (3, None, None)]
    typed = files.read_csv(spark, str(tmp_path / "t.csv"), T.StructType([
        T.StructField("b", T.DoubleType()), T.StructField("a", T.DoubleType())]))
    assert [tuple(r) for r in typed.collect()] == [(None, 1.0), (2.5, None), (None, 3.0)]


def test_scan_directory_is_flat_and_strict(spark, tmp_path):
    for folder in ("x", "x/deep"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "t.csv").write_text("date,v\n2020-01-31,1\n")
    assert set(files.scan_directory(spark, str(tmp_path / "x"))) == {"t_raw"}
    (tmp_path / "x" / "t.txt").write_text("date,v\n2020-01-31,1\n")
    with pytest.raises(ValueError):
        files.scan_directory(spark, str(tmp_path / "x"), pattern="t.*")
    with pytest.raises(FileNotFoundError):
        files.scan_directory(spark, str(tmp_path / "missing"))


def _price_fact(spark):
    rows = [(i, 20190101 + 10000 * (i % 3), 1 + i % 2, 1, float(i)) for i in range(12)]
    return spark.createDataFrame(rows, "fact_price_id long, date_key int, company_key int, "
                                       "stock_metric_key int, value double")


def test_gold_write_with_fewer_years_replaces_all(spark, tmp_path):
    fact = _price_fact(spark)
    files.write_gold(fact, "fact_stock_prices", str(tmp_path))
    files.write_gold(fact.filter("date_key > 20200000"), "fact_stock_prices", str(tmp_path))
    back = files.read_gold(spark, str(tmp_path), ["fact_stock_prices"])["fact_stock_prices"]
    assert sorted({r.date_key // 10000 for r in back.collect()}) == [2020, 2021]
    assert back.count() == 8


def test_price_range_prunes_years(spark, tmp_path):
    files.write_gold(_price_fact(spark), "fact_stock_prices", str(tmp_path))
    fact = files.read_gold(spark, str(tmp_path), ["fact_stock_prices"], keep_year=True)["fact_stock_prices"]
    company = spark.createDataFrame([(1, "T")], "company_key int, ticker string")
    dates = spark.createDataFrame([(20200101, d("2020-01-01"))], "date_key int, date date")
    wide = marts.prices_wide(fact, company, dates, star.dim_stock_metric(spark), "T",
                             "2020-01-01", "2020-12-31")
    plan = wide._jdf.queryExecution().toString()
    found = plan[plan.index("PartitionFilters: ["):][:200]
    assert "year" in found.split("]")[0]
    assert wide.count() == 1


def test_matrix_date_without_a_column_is_an_error(spark):
    long = spark.createDataFrame([("m", d("2020-03-31"), 1.0), ("m", d("2002-03-31"), 2.0)],
                                 "metric_name string, date date, value double")
    with pytest.raises(Exception, match="no column in the matrix"):
        marts.statement_matrix(long, ["2020-03-31"]).collect()


def test_stage_folders_go_and_clusters_need_a_shared_folder(spark, monkeypatch):
    from finmart import session
    with session.stage_scope(spark):
        df = session.materialize(spark.range(3), "scope")
        path = df.inputFiles()[0]
        assert df.count() == 3
    assert not os.path.exists(path.replace("file://", "").replace("file:", ""))

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self): return None
        def getConf(self): return self
        def get(self, key, default=None): return default

    class Session:
        sparkContext, conf = Context(), Context()
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_empty_dimensions_raise_in_the_etl(spark):
    from finmart.plans import etl
    raw = spark.createDataFrame([("bad", "USD", 1.0, "A")],
                                "fiscalDateEnding string, reportedCurrency string, totalRevenue double, symbol string")
    with pytest.raises(ValueError, match="dim_date"):
        etl.run_etl(spark, {"income_statement": raw})


# --- indicators ---------------------------------------------------------------------------------

def _bars(spark, closes):
    rows = [("A", d("2024-01-01") + dt.timedelta(days=i), c, c + 1, c - 1, c, 10 + i)
            for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, date date, open double, high double, "
                                       "low double, close double, volume long")


def test_indicators_need_full_frames(spark):
    bars = _bars(spark, [float(x) for x in range(1, 41)])
    ma = indicators.moving_averages(bars).orderBy("date").collect()
    assert ma[3].ma_5 is None and ma[4].ma_5 == 3.0 and ma[18].ma_20 is None and ma[19].ma_20 == 10.5
    osc = indicators.oscillators(bars).orderBy("date").collect()
    assert osc[13].rsi is None and osc[14].rsi == 100.0 and osc[14].atr == 2.0
    assert osc[24].macd is None and osc[25].macd > 0 and osc[32].macd_signal is None
    band = indicators.bands(bars).orderBy("date").collect()
    assert band[18].middle is None and band[19].upper > band[19].middle > band[19].lower
    flat = indicators.oscillators(_bars(spark, [5.0] * 20)).orderBy("date").collect()
    assert flat[19].rsi is None and flat[19].atr == 2.0     # no move: no ratio


def test_guard_uses_only_earlier_rows(spark):
    out = indicators.guarded(_bars(spark, [1.0, 2.0, 3.0]), ["close"]).orderBy("date").collect()
    assert [r.close for r in out] == [None, 1.0, 2.0]


def test_walk_forward_expands(spark):
    rows = [("A", d("2024-01-01") + dt.timedelta(days=i), float(i), 2.0 * i + 1) for i in range(23)]
    df = spark.createDataFrame(rows, "symbol string, date date, pct_change double, target double")
    out = indicators.walk_forward(df).orderBy("fold").collect()
    assert [(r.train_rows, r.test_rows) for r in out] == [(4, 4), (8, 4), (12, 4), (16, 7)]
    assert all(abs(r.mae) < 1e-9 for r in out)


def test_walk_forward_runs_the_windows_of_a_series_once(spark):
    rows = [(s, d("2024-01-01") + dt.timedelta(days=i), float(i * i % 7), 3.0 * (i * i % 7) - 1)
            for s in ("A", "B", None) for i in range(23)]
    df = spark.createDataFrame(rows, "symbol string, date date, pct_change double, target double")
    out = indicators.walk_forward(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("row_number()") == 1
    got = sorted((r.symbol, r.fold, r.train_rows, r.test_rows, round(r.mae, 9)) for r in out.collect())
    assert got == [(s, f, 4 * f, 4 if f < 4 else 7, 0.0) for s in ("A", "B") for f in (1, 2, 3, 4)]


def test_quantiles_of_many_groups_use_more_tasks_for_more_values(spark, monkeypatch):
    from finmart.operators import stats

    monkeypatch.setattr(stats, "TASK_ROWS", 50)
    df = spark.range(1000).select((F.col("id") % 90).alias("g"), (F.col("id") * 0.5).alias("value"))
    out = stats.exact_quantiles_long(df, "g", "value", [0.25, 0.5], many_groups=True)
    assert out.rdd.getNumPartitions() == 20
    want = {(r.g, p): q for r in df.groupBy("g").agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.5)))
                                                     .alias("q")).collect() for p, q in zip((0.25, 0.5), r.q)}
    assert {(r.g, r.p): r.q for r in out.collect()} == pytest.approx(want)


def test_compare_models_scores_each_model_once(spark):
    from finmart.operators import ml

    rows = [("A", i, "train" if i < 16 else "test", 0.01 * i, *[float(i * k % 5) for k in range(9)]) for i in range(20)]
    frame = spark.createDataFrame(rows, ["symbol", "n", "split", "target", *ml.FEATURES])
    ranked, _ = ml.compare_models(frame, [ml.candidates()[0]])
    assert "UDF" not in ranked._jdf.queryExecution().optimizedPlan().toString()
    assert [r.rank for r in ranked.collect()] == [1]
    assert dict(ml.candidates())["Random Forest"].getMaxMemoryInMB() <= 16   # node sums that a cache holds


def test_divergent_forecasts_are_null_with_a_status(spark):
    rows = [("A", 1, None, 5.0), ("A", 2, None, float("nan")), ("A", 3, None, 7.0), ("B", 1, None, 1e13)]
    df = spark.createDataFrame(rows, "symbol string, step int, date date, predicted_price double")
    out = {(r.symbol, r.step): (r.predicted_price, r.status) for r in forecast.bounded(df).collect()}
    assert out == {("A", 1): (5.0, "ok"), ("A", 2): (None, "diverged"), ("A", 3): (None, "diverged"),
                   ("B", 1): (None, "diverged")}
