"""User-level entry points: the calls a dashboard or script makes, over the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, forecast, marts, ml


def stock_frame(gold: dict[str, DataFrame], ticker: str, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """Wide daily prices of one ticker (empty for an unknown ticker)."""
    return marts.prices_wide(gold["fact_stock_prices"], gold["dim_company"], gold["dim_date"],
                             gold["dim_stock_metric"], ticker, start, end)


def financial_frame(gold: dict[str, DataFrame], ticker: str, fin_type_key: int) -> DataFrame:
    """Long statement facts of one ticker and statement type, with date/metric attributes."""
    return marts.statement_long(gold["fact_finance"], gold["dim_company"], gold["dim_date"],
                                gold["dim_fin_metric"], ticker, fin_type_key)


def train_models(prices: DataFrame, save_path: str | None = None):
    """Label, split per symbol, fit and rank the candidates; returns (ranking, best model)."""
    split = features.train_test_split(features.training_frame(prices))
    return ml.compare_models(split, save_path=save_path)


def run_prediction(spark: SparkSession, prices: DataFrame, horizon: int = 30, model=None,
                   model_path: str | None = None) -> dict:
    """Forecast every symbol ``horizon`` business days ahead, with the recommendation it gives.

    The model is a fitted Spark ML regressor of next-day return, one that ``train_models`` saved at
    ``model_path``, or (default) a per-symbol one-feature OLS on pct_change fitted on each symbol's
    training split.
    """
    if model is None and model_path:
        model = ml.load_model(spark, model_path)
    ctx = forecast.forecast_context(prices)
    if model is None:
        split = features.train_test_split(features.training_frame(prices))
        coef = ml.fit_ols(split.filter(F.col("split") == "train"))
        ctx = ctx.join(coef, "symbol")
        path = forecast.ols_forecast(ctx, horizon)
    else:
        path = forecast.forecast_with_model(ctx, model, horizon)
    return {"context": ctx, "forecast": path, "recommendation": forecast.recommend_basic(path, ctx)}
