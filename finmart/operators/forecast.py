"""Forecast context and recursive multi-step forecasts, parallel over symbols.

The recursion is sequential in the horizon only; each symbol's whole path is one
``aggregate`` over ``sequence(1, h)`` inside a row, so there is no driver loop and
no per-step job. Coefficients may be literals (one pooled model) or columns
(one model per symbol, joined in).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import next_business_day
from ..functions.numeric import percent_change


def forecast_context(prices: DataFrame, key: str = "symbol") -> DataFrame:
    """Per symbol: the latest bar, trailing means (vol 5/20 rows, volume 5 rows) and the
    sample std of daily returns over the whole history."""
    w = Window.partitionBy(key).orderBy(F.col("date").desc_nulls_last())
    ranked = prices.withColumn("__rn", F.row_number().over(w))
    last = F.struct(*[F.col(c).alias(c) for c in
                      ["date", "open", "high", "low", "close", "volume", "pct_change",
                       "daily_return", "volatility_5d", "volatility_20d"]])
    rn = F.col("__rn")
    return ranked.groupBy(key).agg(
        F.max_by(last, F.when(rn == 1, F.lit(1)).otherwise(F.lit(0))).alias("last"),
        F.avg(F.when(rn <= 5, F.col("volatility_5d"))).alias("avg_volatility_5d"),
        F.avg(F.when(rn <= 20, F.col("volatility_20d"))).alias("avg_volatility_20d"),
        F.avg(F.when(rn <= 5, F.col("volume"))).alias("avg_volume"),
        F.stddev_samp("pct_change").alias("daily_volatility"),
    ).select(key, "last.*", "avg_volatility_5d", "avg_volatility_20d", "avg_volume",
             "daily_volatility")


def _as_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def linear_step(state: Column, coefficients: dict[str, object], intercept) -> Column:
    """Predicted return of the state under a linear model (intercept first, then features)."""
    out = _as_col(intercept)
    for name, coef in coefficients.items():
        out = out + _as_col(coef) * state[name]
    return out


def clipped(ret: Column, bounds: tuple[float, float] | None) -> Column:
    """A predicted return held inside ``bounds``. A tree's predictions are means of training returns
    and stay among them; a linear model that is fed with its own output leaves them within a few steps."""
    if bounds is None:
        return ret
    return F.least(F.greatest(ret, F.lit(float(bounds[0]))), F.lit(float(bounds[1])))


def return_bounds(train: DataFrame, label: str = "target", low: float = 0.4,
                  high: float = 0.6) -> tuple[float, float] | None:
    """Two exact quantiles of the training returns (None without rows): by default the range of their
    middle fifth, so that steps of one sign, compounded over a horizon, stay near known prices."""
    from .stats import exact_quantiles_long

    q = exact_quantiles_long(train.select(F.lit(label).alias("name"), F.col(label).alias("value")),
                             "name", "value", [low, high]).collect()   # two rows
    at = {r.p: r.q for r in q}
    return (at[low], at[high]) if at else None


STATE_FIELDS = ["open", "high", "low", "close", "volume", "pct_change", "daily_return",
                "volatility_5d", "volatility_20d"]
PATH_TYPE = "array<struct<step:int,date:date,predicted_price:double>>"


def next_state(get, ret: Column, step: Column) -> dict[str, Column]:
    """One recursion step. ``get(name)`` reads the current state; ``ret`` is the
    predicted return. Open ← previous close, close ← prediction, high/low =
    prediction · (1 ± avg 5-day volatility), volume ← trailing average volume,
    pct_change and daily_return recomputed, volatilities held at their averages,
    date ← next business day; the step is appended to the path."""
    v5, v20, vol = F.col("avg_volatility_5d"), F.col("avg_volatility_20d"), F.col("avg_volume")
    prev = get("close")
    pred = prev * (F.lit(1.0) + ret)
    nxt = next_business_day(get("date"))
    point = F.struct(step.cast("int").alias("step"), nxt.alias("date"),
                     pred.alias("predicted_price"))
    return {"date": nxt, "open": prev, "high": pred * (F.lit(1.0) + v5),
            "low": pred * (F.lit(1.0) - v5), "close": pred, "volume": vol.cast("double"),
            "pct_change": F.try_divide(pred - prev, prev), "daily_return": pred - prev,
            "volatility_5d": v5, "volatility_20d": v20,
            "path": F.concat(get("path"), F.array(point))}


def _initial_state() -> dict[str, Column]:
    return {"date": F.col("date"), **{c: F.col(c).cast("double") for c in STATE_FIELDS},
            "path": F.array().cast(PATH_TYPE)}


def recursive_forecast(ctx: DataFrame, horizon: int, coefficients: dict[str, object],
                       intercept, key: str = "symbol",
                       bounds: tuple[float, float] | None = None) -> DataFrame:
    """h-step recursive forecast under a linear model: predicted close = close · (1 + r̂), r̂ clipped
    to ``bounds``.

    The whole path is one ``aggregate`` over ``sequence(1, h)`` inside each symbol's
    row: pure Catalyst, no per-step job. Returns (key, step, date, predicted_price).
    """
    init = F.struct(*[c.alias(n) for n, c in _initial_state().items()])

    def step(acc, i):
        new = next_state(lambda n: acc[n], clipped(linear_step(acc, coefficients, intercept), bounds), i)
        return F.struct(*[c.alias(n) for n, c in new.items()])

    run = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), init, step)
    return ctx.select(key, F.inline(run["path"]))


def model_forecast(ctx: DataFrame, model, horizon: int, key: str = "symbol",
                   checkpoint_every: int = 10, bounds: tuple[float, float] | None = None) -> DataFrame:
    """h-step recursive forecast under any fitted Spark ML regressor (e.g. a forest).

    The state frame has one row per symbol; each step assembles its features,
    applies ``model.transform`` (a distributed job over symbols) and advances the
    state with the same rules as the linear path. Sequential only in the horizon;
    lineage is cut with a reliable checkpoint every ``checkpoint_every`` steps.
    """
    from ..session import materialize
    from .ml import assemble

    extras = ["avg_volatility_5d", "avg_volatility_20d", "avg_volume"]
    state = ctx.select(key, *extras, *[c.alias(n) for n, c in _initial_state().items()])
    for i in range(1, horizon + 1):
        scored = model.transform(assemble(state, handle_invalid="keep")).drop("features")
        new = next_state(F.col, clipped(F.col("prediction"), bounds), F.lit(i))
        state = scored.select(key, *extras, *[c.alias(n) for n, c in new.items()])
        if i % checkpoint_every == 0 and i < horizon:
            state = materialize(state)
    return state.select(key, F.inline("path"))


def forecast_with_model(ctx: DataFrame, model, horizon: int, key: str = "symbol",
                        bounds: tuple[float, float] | None = None) -> DataFrame:
    """Recursive forecast under a fitted Spark ML model: a linear model's recursion runs
    in-row with its coefficients as literals; any other model steps ``transform``."""
    from pyspark.ml.regression import LinearRegressionModel

    if isinstance(model, LinearRegressionModel):
        from .ml import linear_coefficients
        coefs, intercept = linear_coefficients(model)
        return recursive_forecast(ctx, horizon, coefs, intercept, key, bounds)
    return model_forecast(ctx, model, horizon, key, bounds=bounds)


def ols_forecast(ctx_with_coefficients: DataFrame, horizon: int, feature: str = "pct_change",
                 key: str = "symbol") -> DataFrame:
    """Recursive forecast with per-symbol OLS columns ``slope``/``intercept``."""
    return recursive_forecast(ctx_with_coefficients, horizon, {feature: F.col("slope")},
                              F.col("intercept"), key)


def bounded(path: DataFrame, limit: float = 1e12, key: str = "symbol") -> DataFrame:
    """A forecast without values outside the finite range: predicted_price is NULL from the first
    step whose size passes ``limit`` or is no number, and ``status`` tells (ok, diverged)."""
    p = F.col("predicted_price")
    bad = F.coalesce(F.isnan(p) | (F.abs(p) > limit), F.lit(True))
    w = Window.partitionBy(key).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    gone = F.max(bad).over(w)
    return path.select(key, "step", "date", F.when(~gone, p).alias("predicted_price"),
                       F.when(gone, "diverged").otherwise("ok").alias("status"))


def recommend_basic(forecast: DataFrame, ctx: DataFrame, key: str = "symbol") -> DataFrame:
    """Final predicted price vs the current close, banded at ±2 % and ±0.5 %."""
    summary = forecast.groupBy(key).agg(
        F.max_by("predicted_price", "step").alias("target_price"),
        F.max("predicted_price").alias("highest_price"),
        F.min("predicted_price").alias("lowest_price"))
    out = summary.join(ctx.select(key, F.col("close").alias("current_price")), key)
    chg = percent_change("target_price", "current_price")
    status = F.when(chg > 2.0, "UP_STRONG").when(chg > 0.5, "UP_SLIGHT") \
        .when(chg < -2.0, "DOWN_STRONG").when(chg < -0.5, "DOWN_SLIGHT").otherwise("FLAT")
    action = F.when(chg > 2.0, "BUY").when(chg > 0.5, "CONSIDER_BUY") \
        .when(chg < -2.0, "SELL").when(chg < -0.5, "CAUTION").otherwise("HOLD")
    return out.select(key, "current_price", "target_price", "highest_price", "lowest_price",
                      chg.alias("change_percent"), status.alias("status"),
                      action.alias("action"))
