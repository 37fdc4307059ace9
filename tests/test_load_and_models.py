"""Series in pieces, boosted models, malformed files, saved models and safe warehouse loads."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from finmart.operators import boosting, features, indicators, ml, quality, series
from finmart.schemas import FEATURES, GOLD
from finmart.sources import files

BARS = "symbol string, date date, open double, high double, low double, close double, volume double"


def _bars(n, symbols=("A",), gaps=(), seed=1):
    rng = random.Random(seed)
    rows = []
    for s in symbols:
        price = 100.0
        for k in range(n):
            price *= 1 + rng.gauss(0, 0.02)
            close = None if any(a <= k < b for a, b in gaps) else price
            rows.append((s, dt.date(1990, 1, 1) + dt.timedelta(days=k), price * 0.99, price * 1.02,
                         price * 0.97, close, float(rng.randrange(1, 900))))
    rng.shuffle(rows)
    return rows


def _same(a, b):
    def rows(df):
        return sorted(([None if v is None else round(v, 12) if isinstance(v, float) else str(v)
                        for v in r] for r in df.select(sorted(df.columns)).collect()), key=str)
    assert rows(a) == rows(b)


# --- series in pieces ---------------------------------------------------------------------

def test_one_long_series_spreads_over_tasks(spark):
    """One symbol, 8 partitions: the rows of the plain windows, and no task holds them all."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        bars = spark.createDataFrame(_bars(4000, gaps=[(0, 3), (95, 130), (500, 900), (1990, 1991)]), BARS)
        out = features.add_price_features_in_pieces(bars, rows=100)
        _same(out, features.add_price_features(bars))
        tasks = [r.task for r in out.withColumn("task", F.spark_partition_id()).collect()]
        assert len(set(tasks)) >= 6 and max(map(tasks.count, set(tasks))) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("rows", [21, 64, 10_000])
def test_pieces_of_any_size(spark, rows):
    data = _bars(150, ("A", "B", None), gaps=[(30, 75)]) + [("C", dt.date(2000, 1, 1), 1.0, 1.0, 1.0, None, 1.0)]
    bars = spark.createDataFrame(data, BARS)
    _same(features.add_price_features_in_pieces(bars, rows=rows), features.add_price_features(bars))


def test_indicators_in_pieces(spark):
    bars = spark.createDataFrame(_bars(300, ("A", "B")), BARS)
    for fn, halo in ((indicators.moving_averages, 20), (indicators.bands, 20), (indicators.candles, 5),
                     (indicators.oscillators, 40)):
        _same(series.in_pieces(bars, fn, halo, rows=50), fn(bars))
    assert series.in_pieces(bars.limit(0), indicators.bands, 20, 50).count() == 0
    assert series.longest(bars) == 300 and series.longest(bars.limit(0)) == 0
    with pytest.raises(ValueError):
        series.in_pieces(bars, indicators.bands, 20, 20)


def test_silver_cuts_long_series(spark, monkeypatch):
    from finmart.plans import etl
    bars = spark.createDataFrame(_bars(200), BARS)
    cut = []
    plain = features.add_price_features_in_pieces
    monkeypatch.setattr(etl.features, "add_price_features_in_pieces",
                        lambda df, rows: cut.append(rows) or plain(df, rows))
    _same(etl.silver_prices(bars, series_rows=50), etl.silver_prices(bars))
    etl.silver_prices(bars, series_rows=500)
    assert cut == [50]


# --- boosted models -----------------------------------------------------------------------

def _duck(path, sql):
    import duckdb
    return duckdb.sql(sql.format(f"read_parquet('{path}/*.parquet')")).fetchall()


def test_boosted_metrics_equal_sql_on_the_stored_predictions(spark, tmp_path):
    prices = features.add_price_features(spark.createDataFrame(_bars(160, ("A", "B", "C")), BARS))
    stored = boosting.walk_forward_predictions(prices, folds=2, models=boosting.estimators(3, 2))
    stored.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    got = boosting.direction_metrics(stored).join(boosting.price_metrics(stored).drop("n"), "fold") \
        .orderBy("fold").collect()
    want = _duck(tmp_path / "p", """
      WITH s AS (SELECT *, up = 1 AS t, score >= 0.5 AS said FROM {0}),
      pairs AS (SELECT a.fold, avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END) AS auc
        FROM s a JOIN s b ON a.fold = b.fold AND a.t AND NOT b.t GROUP BY a.fold)
      SELECT s.fold, count(*), count(*) FILTER (WHERE t), avg(CAST(said = t AS DOUBLE)),
        count(*) FILTER (WHERE said AND t) / nullif(count(*) FILTER (WHERE said), 0),
        count(*) FILTER (WHERE said AND t) / nullif(count(*) FILTER (WHERE t), 0),
        2 * count(*) FILTER (WHERE said AND t) / nullif(count(*) FILTER (WHERE t) + count(*) FILTER (WHERE said), 0),
        any_value(auc), avg(abs(move - predicted_move)), sqrt(avg((move - predicted_move) ** 2)),
        avg(CAST(sign(move) = sign(predicted_move) AS DOUBLE)) * 100,
        avg(abs(close_now - close_before * (1 + predicted_move))), avg(abs(close_now - close_before))
      FROM s JOIN pairs USING (fold) GROUP BY s.fold ORDER BY s.fold""")
    assert len(got) == 2 and [tuple(r) for r in got] == [pytest.approx(w) for w in want]


def test_folds_are_cut_from_landed_moves_without_a_shuffle_of_rows(spark, monkeypatch):
    class Seen(Exception):
        pass

    plans, real = [], boosting.date_folds

    def record(frame, folds=3, land=False):
        out = real(frame, folds, land)
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in (frame, out))
        raise Seen
    monkeypatch.setattr(boosting, "date_folds", record)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.raises(Seen):
            boosting.walk_forward_predictions(features.add_price_features(
                spark.createDataFrame(_bars(60, ("A", "B")), BARS)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Window" not in plans[0]
    assert "BroadcastHashJoin" in plans[1] and "SortMergeJoin" not in plans[1]
    assert "Aggregate" not in plans[1]   # nor are the dates counted by every fit


def test_moves_see_only_the_row_before_and_folds_follow_dates(spark):
    prices = features.add_price_features(spark.createDataFrame(_bars(60, ("A", "B")), BARS))
    frame = boosting.date_folds(boosting.move_frame(prices), 3)
    before = {(r.symbol, r.date): r for r in prices.collect()}
    for r in frame.collect():
        old = before[r.symbol, r.date - dt.timedelta(days=1)]
        assert all(r[c] == old[c] for c in FEATURES)
        assert r.move == before[r.symbol, r.date].pct_change and r.up == (r.move > 0)
    spans = frame.groupBy("block").agg(F.min("date"), F.max("date")).orderBy("block").collect()
    assert [s[0] for s in spans] == [0, 1, 2, 3]
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_auc_ties_and_single_classes(spark):
    rows = [(1, 1.0, 0.9), (1, 0.0, 0.9), (1, 0.0, 0.1), (1, 1.0, 0.5), (2, 1.0, 0.2), (3, 0.0, 0.4)]
    df = spark.createDataFrame(rows, "fold int, up double, score double")
    assert {r.fold: r.auc for r in boosting.auc(df, "fold").collect()} == {1: 0.625, 2: None, 3: None}
    m = {r.fold: r for r in boosting.direction_metrics(df).collect()}
    assert m[3].precision is None and m[3].recall is None and m[3].accuracy == 1.0
    assert (m[1].precision, m[1].recall) == (pytest.approx(2 / 3), 1.0)


# --- saved models -------------------------------------------------------------------------

def test_saved_models_predict_the_same_in_another_session(spark, tmp_path):
    from pyspark.ml.regression import LinearRegression, RandomForestRegressor
    split = features.train_test_split(features.training_frame(
        features.add_price_features(spark.createDataFrame(_bars(80, ("A", "B")), BARS)))).persist()
    data = ml.assemble(split)
    fitted = [e(featuresCol="features", labelCol="target").fit(data) for e in (LinearRegression, RandomForestRegressor)]
    for k, model in enumerate(fitted):
        ml.save_model(model, str(tmp_path / str(k)))
        again = ml.load_model(spark.newSession(), str(tmp_path / str(k)))
        assert type(again) is type(model)
        rows = ml.compare_predictions(split, model, again).collect()
        assert len(rows) == 2 and all(r.differing == 0 and r.largest_difference == 0 for r in rows)
    other = ml.compare_predictions(split, *fitted).collect()
    assert all(r.differing > 0 for r in other)
    from finmart.plans import api
    prices = features.add_price_features(spark.createDataFrame(_bars(80, ("A", "B")), BARS))
    out = api.run_prediction(spark, prices, horizon=3, model_path=str(tmp_path / "0"))
    assert out["forecast"].count() == 6


# --- malformed files ----------------------------------------------------------------------

def _ragged(tmp_path):
    (tmp_path / "good.csv").write_text("a,b\n1,x\n2,None\n")
    (tmp_path / "bad.csv").write_text('a,b\n1,x\n2\n3,y,z\n4,"q,r"\n5,w\n')
    (tmp_path / "empty.csv").write_text("a,b\n")
    return {n: str(tmp_path / f"{n}.csv") for n in ("good", "bad", "empty", "missing")}


def test_malformed_records_are_set_aside(spark, tmp_path):
    loaded, bad, failed = files.load_checked(spark, _ragged(tmp_path))
    assert sorted(tuple(r) for r in loaded["bad"].collect()) == [(1, "x"), (4, "q,r"), (5, "w")]
    assert sorted((r.a, r.b or "") for r in loaded["good"].collect()) == [(1, "x"), (2, "")]
    assert loaded["empty"].count() == 0 and failed == ["missing"] and list(bad) == ["bad"]
    assert sorted(r.record for r in bad["bad"].collect()) == ["2", "3,y,z"]
    (count,) = files.bad_counts(bad).collect()
    assert count.source == "bad" and count.file.endswith("bad.csv") and count.bad_rows == 2


def test_malformed_sources_can_be_skipped_or_refused(spark, tmp_path):
    paths = _ragged(tmp_path)
    loaded, bad, failed = files.load_checked(spark, paths, on_bad="skip")
    assert sorted(loaded) == ["empty", "good"] and sorted(failed) == ["bad", "missing"] and list(bad) == ["bad"]
    with pytest.raises(ValueError, match="2 malformed"):
        files.load_checked(spark, {"bad": paths["bad"]}, on_bad="raise")
    with pytest.raises(PySparkException):
        files.load_checked(spark, {"missing": paths["missing"]}, on_bad="raise")


# --- warehouse ----------------------------------------------------------------------------

COMPANIES = [(1, "A", "A Inc", "t", "n"), (2, "B", "B Inc", "t", "n")]


@pytest.fixture()
def warehouse(spark, tmp_path):
    db = f"wh_{random.getrandbits(40):x}"
    files.create_star_tables(spark, db, str(tmp_path / "wh"))

    def frame(name, rows):
        return spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in GOLD[name]))
    files.refresh_table(spark, frame("dim_company", COMPANIES), f"{db}.dim_company", "dim_company")
    return db, frame


def _facts(spark, db):
    return sorted(tuple(r)[:6] for r in spark.table(f"{db}.fact_finance").collect())


def test_a_failed_refresh_leaves_the_old_rows(spark, warehouse):
    db, frame = warehouse
    table = f"{db}.fact_finance"
    assert _facts(spark, db) == []
    old = [(k, 20240101 + k % 3, 1, 1, 1, float(k)) for k in range(50)]
    files.refresh_table(spark, frame("fact_finance", old), table, "fact_finance")
    late = frame("fact_finance", old).repartition(4).withColumn(   # fails in the middle of the write
        "value", F.when(F.col("fact_finance_id") == 49, F.raise_error(F.lit("lost")).cast("double"))
        .otherwise(F.col("value") + 1))
    with pytest.raises(PySparkException):
        files.refresh_table(spark, late, table, "fact_finance")
    assert _facts(spark, db) == old
    for k in range(4):
        files.refresh_table(spark, frame("fact_finance", old[:k]), table, "fact_finance")
        assert _facts(spark, db) == old[:k]
    versions = [t.name for t in spark.catalog.listTables(db) if t.name.startswith("fact_finance__")]
    assert len(versions) == files.KEPT_VERSIONS


def test_a_plain_table_becomes_a_view_on_its_first_refresh(spark, warehouse):
    db, frame = warehouse
    spark.sql(f"DROP VIEW {db}.dim_company")
    frame("dim_company", COMPANIES[:1]).write.saveAsTable(f"{db}.dim_company")
    files.refresh_table(spark, frame("dim_company", COMPANIES), f"{db}.dim_company", "dim_company")
    assert spark.table(f"{db}.dim_company").count() == 2


@pytest.mark.parametrize("rows, why", [
    ([(2, 20240101, 1, 1, 1, 1.0), (2, 20240102, 1, 1, 1, 2.0)], "repeats a key"),
    ([(1, 20240101, 1, 1, 1, 1.0)], "already holds a key"),
    ([(None, 20240101, 1, 1, 1, 1.0)], "is NULL"),
    ([(3, 20240101, 9, 1, 1, 1.0), (4, 20240101, 1, 1, 1, 1.0)], "company_key has no row in dim_company")])
def test_a_bad_batch_is_refused_whole(spark, warehouse, rows, why):
    db, frame = warehouse
    table, parents = f"{db}.fact_finance", {"dim_company": spark.table(f"{db}.dim_company")}
    first = [(1, 20240101, 1, 1, 1, 5.0)]
    assert files.load_rows(spark, frame("fact_finance", first), table, "fact_finance", parents) == {
        "rows": 1, "least_key": 1, "most_key": 1}
    with pytest.raises(PySparkException, match=why):
        files.load_rows(spark, frame("fact_finance", rows), table, "fact_finance", parents)
    assert _facts(spark, db) == first
    more = [(7, 20250101, 2, 1, 1, 1.0), (8, None, None, 1, 1, None)]   # a NULL foreign key is no orphan
    assert files.load_rows(spark, frame("fact_finance", more), table, "fact_finance", parents)["rows"] == 2
    assert _facts(spark, db) == first + more


def test_reconcile_finds_what_differs(spark, warehouse):
    _, frame = warehouse
    rows = [(k, 20240101 + 10000 * (k % 3), 1, 1, 1, float(k)) for k in range(9)]
    gold = {"fact_finance": frame("fact_finance", rows), "dim_company": frame("dim_company", COMPANIES)}
    assert all(r.same for r in quality.reconcile(gold, {n: df.orderBy(F.rand()) for n, df in gold.items()}).collect())
    changed = [(*r[:5], 99.0) if r[0] == 4 else r for r in rows if r[0] != 8]
    out = quality.reconcile(gold, {"fact_finance": frame("fact_finance", changed)})
    assert {(r.table_name, r.year): (r.gold_rows, r.warehouse_rows, r.same) for r in out.collect()} == {
        ("fact_finance", 2024): (3, 3, True), ("fact_finance", 2025): (3, 3, False),
        ("fact_finance", 2026): (3, 2, False), ("dim_company", None): (2, 0, False)}
