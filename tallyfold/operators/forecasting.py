"""Demand forecasting: hold-out, baselines, metrics, models, recursive forecasts.

Every operator treats all products at once. A table that is read more than once
should be stored first (``scratch.materialise``).
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions import numeric
from tallyfold.operators import boosting, demand
from tallyfold.operators.profiles import append_average
from tallyfold.schemas import require_columns
from tallyfold.scratch import materialise

HOLD_OUT_DAYS = 30
MIN_TRAIN_ROWS = 14
INTERVAL_Z = 1.645
BACKTEST_BAND = 0.20
TAIL_DAYS = 14

# Default settings of the boosted trees and the tuning space.
GBT_DEFAULTS = {"rounds": 200, "depth": 4, "rate": 0.05, "subsample": 0.8, "columns": 0.8, "seed": 42}
TUNING_SPACE = {
    "rounds": (100, 600), "depth": (2, 8), "rate": (0.01, 0.3), "subsample": (0.5, 1.0),
    "columns": (0.5, 1.0), "min_rows": (1, 10), "min_gain": (0.0, 5.0),
}


# -- hold-out ---------------------------------------------------------------


def temporal_split(features: DataFrame, days: int = HOLD_OUT_DAYS) -> DataFrame:
    """Mark the last ``days`` days of the table ``test`` and the rest ``train``."""
    cutoff = F.date_sub(features.agg(F.max("date")).scalar(), days - 1)
    return features.withColumn("part", F.when(F.col("date") < cutoff, "train").otherwise("test"))


def temporal_split_by_product(features: DataFrame, days: int = HOLD_OUT_DAYS,
                              min_train: int = MIN_TRAIN_ROWS) -> DataFrame:
    """The same per product, with the cutoff day; products with too little history are left out."""
    whole = Window.partitionBy("product")
    cut = features.withColumn("cutoff", F.date_sub(F.max("date").over(whole), days))
    marked = cut.withColumn(
        "part", F.when(F.col("date") <= F.col("cutoff"), "train").otherwise("test")
    )
    sized = marked.withColumns(
        {
            "_train": F.count_if(F.col("part") == "train").over(whole),
            "_test": F.count_if(F.col("part") == "test").over(whole),
        }
    )
    return sized.where((F.col("_train") >= min_train) & (F.col("_test") > 0)).drop("_train", "_test")


def part(split: DataFrame, name: str) -> DataFrame:
    return split.where(F.col("part") == name).drop("part")


# -- baselines and metrics -----------------------------------------------------


def seasonal_naive(split: DataFrame) -> DataFrame:
    """Test rows with the last training revenue of the same weekday as ``prediction``.

    A weekday never seen in training takes the training mean. One row per product,
    holding at most seven values, is joined to the test rows.
    """
    per_day = part(split, "train").groupBy("product", "day_of_week").agg(
        F.max_by("revenue", "date").alias("y"), F.sum("revenue").alias("s"), F.count("revenue").alias("n")
    )
    known = per_day.groupBy("product").agg(
        F.map_from_entries(F.collect_list(F.struct("day_of_week", "y"))).alias("_by_day"),
        (F.sum("s") / F.sum("n")).alias("_mean"),
    )
    return (
        part(split, "test")
        .join(known, "product", "left")
        .withColumn("prediction", F.coalesce(F.col("_by_day")[F.col("day_of_week")], F.col("_mean")))
        .drop("_by_day", "_mean")
    )


def forecast_metrics(predictions: DataFrame, by: Sequence[str] = ("product",), clip: bool = True) -> DataFrame:
    """MAE and RMSE over all rows, MAPE % over rows with a true value other than 0.

    MAPE is NULL when there is no such row. Predictions are floored at 0 unless
    ``clip`` is off, which is how training errors are reported.
    """
    require_columns(predictions, ["revenue", "prediction", *by])
    y = F.col("revenue")
    p = numeric.clip_at_zero(F.col("prediction")) if clip else F.col("prediction")
    return predictions.groupBy(*by).agg(
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg(F.pow(y - p, F.lit(2.0)))).alias("rmse"),
        (F.avg(F.when(y != 0, F.abs((y - p) / y))) * 100).alias("mape"),
    )


def mean_metrics(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean of each metric over products; NaN and NULL do not count."""
    names = ["mae", "rmse", "mape"]
    clean = metrics.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in names})
    return clean.groupBy(*by).agg(
        *[F.avg(c).alias(c) for c in names], F.count("*").alias("n_products")
    )


def select_champion(means: DataFrame) -> DataFrame:
    """One row: the model with the lowest mean MAPE; models without one do not take part."""
    known = means.withColumn("mape", numeric.without_nan(F.col("mape"))).where("mape IS NOT NULL")
    return known.agg(
        F.min_by("model", F.struct("mape", "model")).alias("champion"), F.min("mape").alias("mape")
    )


def model_leaderboard(metrics: DataFrame, metric: str, best: str = "low") -> DataFrame:
    """Models in order of a metric, with their place; a handful of rows."""
    order = F.col(metric).asc_nulls_last() if best == "low" else F.col(metric).desc_nulls_last()
    place = F.row_number().over(Window.partitionBy().orderBy(order, "model"))
    return metrics.withColumn("place", place)


def comparison_table(metrics: DataFrame, models: Sequence[str]) -> DataFrame:
    """MAPE by product and model, plus the AVERAGE row."""
    wide = metrics.groupBy("product").pivot("model", list(models)).agg(F.first("mape"))
    return append_average(wide, "product", models)


# -- seasonal regression -------------------------------------------------------


@dataclass(frozen=True)
class SeasonalTerms:
    """Design of the seasonal regression: trend, weekday and yearly waves."""

    origin: str = "2000-01-01"
    waves: int = 3
    ridge: float = 1e-6

    def columns(self, date: str = "date") -> list[Column]:
        day = F.datediff(F.col(date), F.lit(self.origin).cast("date")).cast("double")
        terms = [F.lit(1.0), day / F.lit(365.25)]
        weekday = F.weekday(date)
        terms += [(weekday == d).cast("double") for d in range(1, 7)]
        for k in range(1, self.waves + 1):
            angle = day * F.lit(2.0 * math.pi * k / 365.25)
            terms += [F.sin(angle), F.cos(angle)]
        return terms


def fit_seasonal_regression(train: DataFrame, terms: SeasonalTerms = SeasonalTerms()) -> DataFrame:
    """``product, beta array<double>``: least squares for all products in one grouping.

    The sums of the normal equations are ordinary aggregates, combined before the
    shuffle; only their small system per product is solved in Python.
    """
    x = terms.columns()
    size = len(x)
    rows = train.select("product", F.col("revenue").alias("y"), F.array(*x).alias("x"))
    gram = ", ".join(f"sum(x[{i}] * x[{j}])" for i in range(size) for j in range(i, size))
    moment = ", ".join(f"sum(x[{i}] * y)" for i in range(size))
    sums = rows.groupBy("product").agg(
        F.expr(f"array({gram})").alias("gram"), F.expr(f"array({moment})").alias("moment")
    )
    upper = np.triu_indices(size)
    ridge = terms.ridge

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(gram: pd.Series, moment: pd.Series) -> pd.Series:
        def one(g, m):
            a = np.zeros((size, size))
            a[upper] = g
            a = a + a.T - np.diag(a.diagonal())
            return np.linalg.solve(a + ridge * np.eye(size), np.asarray(m))

        return pd.Series([one(g, m) for g, m in zip(gram, moment)])

    return sums.select("product", solve("gram", "moment").alias("beta"))


def predict_seasonal_regression(rows: DataFrame, betas: DataFrame,
                                terms: SeasonalTerms = SeasonalTerms()) -> DataFrame:
    """Rows with ``prediction``, floored at 0; NULL for a product without a fit."""
    fitted = sum((F.col("beta")[i] * c for i, c in enumerate(terms.columns())), F.lit(0.0))
    return (
        rows.join(betas, "product", "left")
        .withColumn("prediction", numeric.clip_at_zero(fitted))
        .drop("beta")
    )


# -- boosted trees ------------------------------------------------------------


@dataclass(frozen=True)
class DemandModel:
    """The stored trees of every product, see ``boosting``."""

    trees: DataFrame


def train_demand_gbt(train: DataFrame, params: dict | None = None) -> DemandModel:
    """Boosted trees per product, all products at once: a product has no more rows than the calendar days."""
    require_columns(train, [*demand.MODEL_FEATURES, "revenue"])
    settings = [{**GBT_DEFAULTS, **(params or {})}]
    trees = boosting.fit_groups(train, "product", demand.MODEL_FEATURES, "revenue", "date", settings)
    return DemandModel(materialise(trees, "trees"))


def train_tuned(train: DataFrame, tuned: DataFrame, settings: Sequence[dict]) -> DemandModel:
    """Boosted trees per product with the setting that ``tuned`` (``product, trial``) found for it."""
    rows = train.join(tuned.select("product", F.col("trial").cast("int").alias("trial")), "product")
    trees = boosting.fit_groups(rows, "product", demand.MODEL_FEATURES, "revenue", "date", settings, "trial")
    return DemandModel(materialise(trees, "trees"))


def predict_demand(model: DemandModel, rows: DataFrame) -> DataFrame:
    """All rows with ``prediction``, floored at 0; NULL for a product the training did not hold."""
    require_columns(rows, demand.MODEL_FEATURES)
    scored = boosting.predict_groups(rows, model.trees, "product", demand.MODEL_FEATURES)
    return scored.withColumn("prediction", numeric.clip_at_zero(F.col("prediction")))


def retrain_errors(features: DataFrame, params: dict | None = None, min_rows: int = 20) -> DataFrame:
    """Fit on all rows of the products with enough of them; mean training errors and product count."""
    enough = features.groupBy("product").agg(F.count("*").alias("n")).where(F.col("n") >= min_rows)
    rows = materialise(features.join(enough.select("product"), "product", "left_semi"), "retrain")
    model = train_demand_gbt(rows, params)
    return mean_metrics(forecast_metrics(predict_demand(model, rows), clip=False))


def draw_params(trials: int, seed: int = 42, space: dict | None = None) -> list[dict]:
    """Seeded random settings; the learning rate is drawn on a log scale."""
    rng = random.Random(seed)
    space = space or TUNING_SPACE
    drawn = []
    for _ in range(trials):
        one = {}
        for name, (low, high) in space.items():
            if name == "rate":
                one[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
            elif isinstance(low, int):
                one[name] = rng.randint(low, high)
            else:
                one[name] = rng.uniform(low, high)
        drawn.append(one)
    return drawn


def tuning_settings(trials: int = 20, seed: int = 42, space: dict | None = None) -> list[dict]:
    return [{**GBT_DEFAULTS, **drawn} for drawn in draw_params(trials, seed, space)]


def tune_demand(split: DataFrame, settings: Sequence[dict] | None = None) -> DataFrame:
    """``product, trial, mape, params``: the setting with the lowest hold-out error, for each product.

    All settings of all products are fitted side by side, each on the training part of its product.
    """
    settings = settings or tuning_settings()
    rows = split.withColumn("_test", F.col("part") == "test")
    tried = boosting.try_settings(
        rows, "product", demand.MODEL_FEATURES, "revenue", "date", settings, "_test"
    )
    scored = forecast_metrics(tried, ["product", "trial"])
    known = F.coalesce(numeric.without_nan(F.col("mape")), F.lit(float("inf")))
    best = F.min_by(F.struct("trial", "mape"), F.struct(known, F.col("trial")))
    texts = [", ".join(f"{k}={v:.6g}" for k, v in sorted(p.items())) for p in settings]
    params = F.array(*[F.lit(t) for t in texts])
    return (
        scored.groupBy("product").agg(best.alias("b")).select("product", "b.*")
        .withColumn("params", F.get(params, F.col("trial")))
    )


# -- champion --------------------------------------------------------------------

Predictor = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Candidate:
    """A fitted forecaster: its hold-out rows with ``prediction`` and how to predict others."""

    tested: DataFrame
    predict: Predictor


def demand_candidates(split: DataFrame, params: dict | None = None) -> dict[str, Candidate]:
    """Seasonal naive, seasonal regression and boosted trees on the same hold-out."""
    train, test = materialise(part(split, "train"), "train"), part(split, "test")
    betas = materialise(fit_seasonal_regression(train), "betas")
    trees = train_demand_gbt(train, params)
    predictors: dict[str, Predictor] = {
        # Ahead of the data, the last value of the same weekday is a week old.
        "seasonal_naive": lambda rows: rows.withColumn("prediction", F.col("lag_7")),
        "seasonal_regression": lambda rows: predict_seasonal_regression(rows, betas),
        "boosted_trees": lambda rows: predict_demand(trees, rows),
    }
    tested = {name: predict(test) for name, predict in predictors.items()}
    tested["seasonal_naive"] = seasonal_naive(split)
    return {name: Candidate(materialise(tested[name], "tested"), predictors[name]) for name in predictors}


def demand_leaderboard(candidates: dict[str, Candidate]) -> DataFrame:
    """``model, mae, rmse, mape, n_products, place`` by mean MAPE; the first is the champion."""
    scored = [
        mean_metrics(forecast_metrics(c.tested)).withColumn("model", F.lit(name)) for name, c in candidates.items()
    ]
    means = reduce(DataFrame.unionByName, scored)
    return model_leaderboard(means.select("model", "mae", "rmse", "mape", "n_products"), "mape")


# -- forecasts ------------------------------------------------------------------


def recursive_forecast(history: DataFrame, predict: Predictor, horizon: int,
                       store_every: int = 10) -> DataFrame:
    """``product, date, step, predicted_revenue`` for ``horizon`` days after the history.

    Each product is one row that carries its days as an array, so a step is a
    projection and needs no shuffle. A missing day counts as 0, and the rolling means
    always divide by 7 and 14. ``predict`` adds ``prediction`` to rows with the model
    features. The state is stored every few steps to keep plans short.
    """
    state = materialise(forecast_state(history), "forecast-state")

    for step in range(1, horizon + 1):
        # The generator keeps the optimiser from inlining one step into all later ones.
        state = predict(step_features(state, step)).selectExpr(
            "product", "last", "explode(array(concat(path, array(greatest(prediction, 0D))))) AS path"
        )
        if step % store_every == 0 and step < horizon:
            state = materialise(state, "forecast-state")
    ahead = F.slice("path", TAIL_DAYS + 1, horizon)
    return state.select("product", "last", F.posexplode(ahead).alias("i", "predicted_revenue")).select(
        "product",
        F.date_add("last", F.col("i") + 1).alias("date"),
        (F.col("i") + 1).alias("step"),
        "predicted_revenue",
    )


def forecast_state(history: DataFrame) -> DataFrame:
    """``product, last, path``: the last day of each product and its last days, oldest first."""
    last = F.max("date").over(Window.partitionBy("product"))
    tail = (
        history.select("product", "date", "revenue", last.alias("last"))
        .where(F.col("date") > F.date_sub("last", TAIL_DAYS))
        .withColumn("ago", F.datediff("last", "date"))
    )
    # Predictions are appended behind the last day of the history.
    days = ", ".join(
        f"coalesce(max(IF(ago = {TAIL_DAYS - 1 - i}, revenue, NULL)), 0D)" for i in range(TAIL_DAYS)
    )
    return tail.groupBy("product", "last").agg(F.expr(f"array({days})").alias("path"))


def step_features(state: DataFrame, step: int) -> DataFrame:
    """The state with ``date`` and the model features of the ``step``-th day ahead."""
    known = TAIL_DAYS + step - 1
    means = {w: " + ".join(f"path[{known - k}]" for k in range(1, w + 1)) for w in demand.ROLLING_WINDOWS}
    return state.selectExpr(
        "product",
        "last",
        "path",
        f"date_add(last, {step}) AS date",
        *[f"path[{known - k}] AS lag_{k}" for k in demand.LAGS],
        *[f"({total}) / {w} AS rolling_mean_{w}" for w, total in means.items()],
        f"CAST(weekday(date_add(last, {step})) AS TINYINT) AS day_of_week",
        f"CAST(weekday(date_add(last, {step})) >= 5 AS TINYINT) AS is_weekend",
        f"CAST(month(date_add(last, {step})) AS TINYINT) AS month",
    )


def build_future_features(history: DataFrame) -> DataFrame:
    """``product, date`` and the eight model features of the day after each product's history."""
    return step_features(forecast_state(history), 1).select("product", "date", *demand.MODEL_FEATURES)


def residual_spread(test_predictions: DataFrame) -> DataFrame:
    """``product, spread``: deviation of the hold-out residuals; a fifth of the mean for one row."""
    residual = F.col("revenue") - numeric.clip_at_zero(F.col("prediction"))
    return test_predictions.groupBy("product").agg(
        F.when(F.count("*") > 1, F.stddev_pop(residual))
        .otherwise(F.avg("revenue") * 0.2).alias("spread")
    )


def forecast_interval(forecast: DataFrame, spread: DataFrame, z: float = INTERVAL_Z) -> DataFrame:
    """Add ``lower_bound`` (at least 0) and ``upper_bound``."""
    reach = F.col("spread") * z
    return forecast.join(spread, "product", "left").select(
        *forecast.columns,
        numeric.clip_at_zero(F.col("predicted_revenue") - reach).alias("lower_bound"),
        (F.col("predicted_revenue") + reach).alias("upper_bound"),
    )


def union_horizons(forecast: DataFrame, horizons: Sequence[int] = (7, 30)) -> DataFrame:
    """The forecast once per horizon, cut to it; the shorter one is a prefix of the longer."""
    spread = forecast.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    return spread.where(F.col("step") <= F.col("horizon")).drop("step")


def backtest_bands(test_predictions: DataFrame, band: float = BACKTEST_BAND) -> DataFrame:
    """Hold-out predictions with a fixed relative band; ``horizon`` is the day offset."""
    p = numeric.clip_at_zero(F.col("prediction"))
    return test_predictions.select(
        "product",
        "date",
        p.alias("predicted_revenue"),
        numeric.clip_at_zero(p - p * band).alias("lower_bound"),
        (p + p * band).alias("upper_bound"),
        F.datediff("date", "cutoff").alias("horizon"),
    )


# -- decomposition ---------------------------------------------------------------


def seasonal_decompose(series: DataFrame, value: str, period: int) -> DataFrame:
    """Additive parts of each product's daily series; ``period`` must be odd.

    Trend is the centred mean over one period and NULL where the period is cut off;
    the seasonal part averages to 0 over a period.
    """
    half = period // 2
    order = Window.partitionBy("product").orderBy("date")
    frame = order.rowsBetween(-half, half)
    y = F.col(value).cast("double")
    numbered = series.select(
        "product", "date", y.alias("observed"),
        F.pmod(F.row_number().over(order) - 1, F.lit(period)).alias("phase"),
        F.when(F.count(F.lit(1)).over(frame) == period, F.avg(y).over(frame)).alias("trend"),
    )
    whole = Window.partitionBy("product")
    by_phase = Window.partitionBy("product", "phase")
    raw = numbered.withColumn("_raw", F.avg(F.col("observed") - F.col("trend")).over(by_phase))
    # Each phase counts once in the mean, however many rows it has.
    weight = F.lit(1.0) / F.count(F.lit(1)).over(by_phase)
    centred = raw.withColumn("_w", weight).withColumn(
        "seasonal",
        F.col("_raw") - F.sum(F.col("_raw") * F.col("_w")).over(whole)
        / F.sum(F.when(F.col("_raw").isNotNull(), F.col("_w"))).over(whole),
    )
    return centred.select(
        "product", "date", "observed", "trend", "seasonal",
        (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("residual"),
    )
