"""Registered queries: forecasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import cleaning, decisions, demand, forecasting as fc, profiles, reports
from tallyfold.plans import inputs, sqltext as S
from tallyfold.plans.registry import query
from tallyfold.scratch import materialise
from tallyfold.sources import adapters

BANDS = "greatest(p - 0.2 * p, 0.0) AS lower_bound, p + 0.2 * p AS upper_bound"
METRICS = """avg(abs(revenue - greatest({p}, 0.0))) AS mae,
       sqrt(avg(pow(revenue - greatest({p}, 0.0), 2))) AS rmse,
       avg(CASE WHEN revenue <> 0 THEN abs((revenue - greatest({p}, 0.0)) / revenue) END) * 100 AS mape"""

CANDIDATES = """candidates AS (
  SELECT 'seasonal_naive' AS model, product, date, revenue, prediction FROM naive
  UNION ALL SELECT 'last_week', product, date, revenue, lag_7 FROM test
  UNION ALL SELECT 'rolling_week', product, date, revenue, rolling_mean_7 FROM test),
by_model AS (SELECT model, product, """ + METRICS.format(p="prediction") + """ FROM candidates GROUP BY 1, 2),
means AS (SELECT model, avg(mae) AS mae, avg(rmse) AS rmse, avg(mape) AS mape, count(*) AS n_products FROM by_model GROUP BY 1)"""

METRIC_DOUBLES = "mae:6 rmse:6 mape:6"


def stored_demand(spark, sf_dir) -> DataFrame:
    return materialise(inputs.demand_table(spark, sf_dir), "demand")


def stored_split(spark, sf_dir) -> DataFrame:
    return fc.temporal_split(stored_demand(spark, sf_dir))


def candidates(split: DataFrame) -> DataFrame:
    """Three baselines on the hold-out, as ``model, product, date, revenue, prediction``."""
    keep = ["product", "date", "revenue", "prediction"]
    test = fc.part(split, "test")
    tables = {
        "seasonal_naive": fc.seasonal_naive(split),
        "last_week": test.withColumn("prediction", F.col("lag_7")),
        "rolling_week": test.withColumn("prediction", F.col("rolling_mean_7")),
    }
    parts = [t.select(F.lit(name).alias("model"), *keep) for name, t in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def candidate_metrics(spark, sf_dir) -> DataFrame:
    return fc.forecast_metrics(candidates(stored_split(spark, sf_dir)), ["model", "product"])


@query("temporal_split", S.naive_sql("""
SELECT product, date, CASE WHEN date < c THEN 'train' ELSE 'test' END AS part FROM demand, cut"""))
def _(spark, sf_dir):
    return stored_split(spark, sf_dir).select("product", "date", "part")


@query("temporal_split_by_product", S.demand_sql("""
SELECT product, date, max(date) OVER (PARTITION BY product) - 30 AS cutoff,
       CASE WHEN date <= max(date) OVER (PARTITION BY product) - 30 THEN 'train' ELSE 'test' END AS part FROM demand"""))
def _(spark, sf_dir):
    split = fc.temporal_split_by_product(inputs.demand_table(spark, sf_dir))
    return split.select("product", "date", "cutoff", "part")


@query("asof_same_weekday", S.naive_sql("SELECT product, date, prediction FROM naive"), "prediction")
@query("seasonal_naive", S.naive_sql("SELECT product, date, prediction FROM naive"), "prediction")
def _(spark, sf_dir):
    return fc.seasonal_naive(stored_split(spark, sf_dir)).select("product", "date", "prediction")


@query("forecast_metrics", S.naive_sql(f"SELECT product, {METRICS.format(p='prediction')} FROM naive GROUP BY 1"), METRIC_DOUBLES)
def _(spark, sf_dir):
    return fc.forecast_metrics(fc.seasonal_naive(stored_split(spark, sf_dir)))


@query("mean_metrics", S.naive_sql("SELECT * FROM means", CANDIDATES), METRIC_DOUBLES)
def _(spark, sf_dir):
    return fc.mean_metrics(candidate_metrics(spark, sf_dir), ["model"])


@query("select_demand_champion", S.naive_sql("""
SELECT model AS champion, mape FROM means ORDER BY mape, model LIMIT 1""", CANDIDATES), "mape:6")
def _(spark, sf_dir):
    return fc.select_champion(fc.mean_metrics(candidate_metrics(spark, sf_dir), ["model"]))


@query("model_leaderboard", S.naive_sql("""
SELECT model, mape, CAST(row_number() OVER (ORDER BY mape, model) AS INTEGER) AS place FROM means""", CANDIDATES), "mape:6")
def _(spark, sf_dir):
    means = fc.mean_metrics(candidate_metrics(spark, sf_dir), ["model"])
    return fc.model_leaderboard(means.select("model", "mape"), "mape")


WIDE = """wide AS (
  SELECT product, max(mape) FILTER (model = 'seasonal_naive') AS seasonal_naive,
         max(mape) FILTER (model = 'last_week') AS last_week,
         max(mape) FILTER (model = 'rolling_week') AS rolling_week FROM by_model GROUP BY 1)"""


@query("comparison_table", S.naive_sql("""
SELECT * FROM wide UNION ALL SELECT 'AVERAGE', avg(seasonal_naive), avg(last_week), avg(rolling_week) FROM wide""",
    CANDIDATES, WIDE), "seasonal_naive:6 last_week:6 rolling_week:6")
def _(spark, sf_dir):
    return fc.comparison_table(
        candidate_metrics(spark, sf_dir), ["seasonal_naive", "last_week", "rolling_week"]
    )


@query("append_average_row", S.naive_sql(f"""
SELECT product, mape FROM (SELECT product, {METRICS.format(p='prediction')} FROM naive GROUP BY 1)
UNION ALL SELECT 'AVERAGE', avg(mape) FROM (SELECT product, {METRICS.format(p='prediction')} FROM naive GROUP BY 1)"""), "mape:6")
def _(spark, sf_dir):
    metrics = fc.forecast_metrics(fc.seasonal_naive(stored_split(spark, sf_dir)))
    return profiles.append_average(metrics, "product", ["mape"])


def blend(rows: DataFrame) -> DataFrame:
    """A fixed lag model, so that the recursion itself can be checked with SQL."""
    return rows.withColumn(
        "prediction",
        0.5 * F.col("lag_7") + 0.3 * F.col("rolling_mean_14") + 0.2 * F.col("lag_1"),
    )


RECURSION = """hist AS (
  SELECT product, max(date) AS last, list(revenue ORDER BY date) FILTER (date > mx - 14) AS tail
  FROM (SELECT *, max(date) OVER (PARTITION BY product) AS mx FROM demand) GROUP BY product),
steps AS (
  WITH RECURSIVE walk AS (
    SELECT product, last, tail, 0 AS step, CAST(NULL AS DOUBLE) AS p FROM hist
    UNION ALL
    SELECT product, last, list_append(tail[2:14], q) AS tail, step + 1, q FROM (
      SELECT product, last, tail, step,
             greatest(0.5 * tail[8] + 0.3 * (list_sum(tail) / 14) + 0.2 * tail[14], 0.0) AS q
      FROM walk WHERE step < 30))
  SELECT product, CAST(last + step AS DATE) AS date, step, p AS predicted_revenue FROM walk WHERE step > 0)"""

SPREAD = """spread AS (
  SELECT product, stddev_pop(revenue - prediction) AS spread FROM naive GROUP BY 1),
bounded AS (
  SELECT steps.*, greatest(predicted_revenue - 1.645 * spread, 0.0) AS lower_bound,
         predicted_revenue + 1.645 * spread AS upper_bound FROM steps JOIN spread USING (product))"""

BOUND_DOUBLES = "predicted_revenue:5 lower_bound:5 upper_bound:5"


@query("recursive_forecast", S.demand_sql("SELECT * FROM steps", RECURSION), "predicted_revenue:5")
def _(spark, sf_dir):
    return fc.recursive_forecast(inputs.demand_table(spark, sf_dir), blend, 30)


@query("build_future_features", S.demand_sql("""
SELECT product, last + 1 AS date, coalesce(max(revenue) FILTER (ago = 0), 0.0) AS lag_1,
       coalesce(max(revenue) FILTER (ago = 6), 0.0) AS lag_7, coalesce(max(revenue) FILTER (ago = 13), 0.0) AS lag_14,
       coalesce(sum(revenue) FILTER (ago < 7), 0.0) / 7 AS rolling_mean_7,
       coalesce(sum(revenue) FILTER (ago < 14), 0.0) / 14 AS rolling_mean_14,
       CAST(isodow(last + 1) - 1 AS TINYINT) AS day_of_week, CAST(isodow(last + 1) > 5 AS TINYINT) AS is_weekend,
       CAST(month(last + 1) AS TINYINT) AS month
FROM (SELECT *, last - date AS ago FROM (SELECT product, date, revenue, max(date) OVER (PARTITION BY product) AS last FROM demand))
GROUP BY product, last"""), "lag_1 lag_7 lag_14 rolling_mean_7:8 rolling_mean_14:8")
def _(spark, sf_dir):
    return fc.build_future_features(inputs.demand_table(spark, sf_dir))


@query("offset_lookup", S.demand_sql("""
SELECT d.product, d.date, coalesce(a.revenue, 0.0) AS day_before, coalesce(b.revenue, 0.0) AS week_before,
       coalesce(c.revenue, 0.0) AS fortnight_before
FROM daily d LEFT JOIN daily a ON a.product = d.product AND a.date = d.date - 1
LEFT JOIN daily b ON b.product = d.product AND b.date = d.date - 7
LEFT JOIN daily c ON c.product = d.product AND c.date = d.date - 14"""), "day_before week_before fortnight_before")
def _(spark, sf_dir):
    # Lags over the dense calendar are the values of the offset days.
    dense = stored_demand(spark, sf_dir)
    return dense.where("n_transactions > 0").select(
        "product", "date", F.col("lag_1").alias("day_before"), F.col("lag_7").alias("week_before"),
        F.col("lag_14").alias("fortnight_before"),
    )


def bounded_forecast(spark, sf_dir) -> DataFrame:
    split = stored_split(spark, sf_dir)
    steps = fc.recursive_forecast(split.drop("part"), blend, 30)
    return fc.forecast_interval(steps, fc.residual_spread(fc.seasonal_naive(split)))


@query("forecast_interval", S.naive_sql("SELECT * FROM bounded", RECURSION, SPREAD), BOUND_DOUBLES)
def _(spark, sf_dir):
    return bounded_forecast(spark, sf_dir)


HORIZONS = """forecast AS (
  SELECT * EXCLUDE (step), 7 AS horizon FROM bounded WHERE step <= 7
  UNION ALL SELECT * EXCLUDE (step), 30 FROM bounded)"""


@query("union_horizons", S.naive_sql("SELECT * FROM forecast", RECURSION, SPREAD, HORIZONS), BOUND_DOUBLES)
def _(spark, sf_dir):
    return fc.union_horizons(bounded_forecast(spark, sf_dir))


@query("demand_kpis", S.naive_sql("""
SELECT product, sum(predicted_revenue) FILTER (horizon = 7) AS forecast_7d,
       sum(predicted_revenue) FILTER (horizon = 30) AS forecast_30d FROM forecast GROUP BY 1""",
    RECURSION, SPREAD, HORIZONS), "forecast_7d forecast_30d")
def _(spark, sf_dir):
    return reports.demand_kpis(fc.union_horizons(bounded_forecast(spark, sf_dir)))


@query("demand_drop_alert", S.naive_sql("""
SELECT k.product, forecast_7d, daily_mean, daily_mean > 0 AND forecast_7d < 0.8 * (daily_mean * 7) AS at_risk
FROM (SELECT product, sum(predicted_revenue) FILTER (horizon = 7) AS forecast_7d FROM forecast GROUP BY 1) k
JOIN (SELECT product, avg(revenue) AS daily_mean FROM daily GROUP BY 1) h USING (product)""",
    RECURSION, SPREAD, HORIZONS), "forecast_7d daily_mean:6")
def _(spark, sf_dir):
    forecast = fc.union_horizons(bounded_forecast(spark, sf_dir))
    return reports.demand_drop_alert(forecast, inputs.daily(spark, sf_dir))


@query("forecast_view", S.naive_sql("""
SELECT 'history' AS series, product, date, revenue, CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound
FROM daily QUALIFY date >= max(date) OVER (PARTITION BY product) - 60
UNION ALL SELECT 'forecast_' || horizon, product, date, predicted_revenue, lower_bound, upper_bound FROM forecast""",
    RECURSION, SPREAD, HORIZONS), "revenue:5 lower_bound:5 upper_bound:5")
def _(spark, sf_dir):
    forecast = fc.union_horizons(bounded_forecast(spark, sf_dir))
    daily = cleaning.product_whitelist(inputs.daily(spark, sf_dir), adapters.FORECAST_TYPES, "product")
    return reports.forecast_view(daily, forecast)


@query("backtest_forecast", S.naive_sql(f"""
SELECT product, date, p AS predicted_revenue, {BANDS}, CAST(date - (c - 1) AS INTEGER) AS horizon
FROM (SELECT product, date, prediction AS p FROM naive), cut"""), BOUND_DOUBLES)
def _(spark, sf_dir):
    split = fc.temporal_split_by_product(stored_demand(spark, sf_dir))
    return fc.backtest_bands(fc.seasonal_naive(split))


def decompose_sql(period: int, min_days: int) -> str:
    half = period // 2
    return S.with_ctes(S.SALES, S.DAILY_ALL, f"""viable AS (
  SELECT product FROM daily_all GROUP BY 1
  HAVING max(date) - min(date) + 1 >= {min_days} AND count(*) >= (max(date) - min(date) + 1) * 0.3)""",
        S.OWN_GRID, f"""numbered AS (
  SELECT product, date, CAST(n_transactions AS DOUBLE) AS observed,
         (row_number() OVER (PARTITION BY product ORDER BY date) - 1) % {period} AS phase,
         CASE WHEN count(*) OVER w = {period} THEN avg(n_transactions) OVER w END AS trend
  FROM own_grid WHERE product IN (SELECT product FROM viable)
  WINDOW w AS (PARTITION BY product ORDER BY date ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)),
phases AS (SELECT product, phase, avg(observed - trend) AS raw FROM numbered GROUP BY 1, 2),
centred AS (SELECT product, phase, raw - avg(raw) OVER (PARTITION BY product) AS seasonal FROM phases)""", body="""
SELECT product, date, observed, trend, seasonal, observed - trend - seasonal AS residual
FROM numbered JOIN centred USING (product, phase)""")


def decomposed(spark, sf_dir, season: str, period: int) -> DataFrame:
    daily = materialise(inputs.daily(spark, sf_dir), "daily")
    viable = decisions.series_viability(profiles.active_days(daily), season).where("status = 'ok'")
    counts = daily.join(viable.select("product"), "product", "left_semi").select(
        "product", "date", "n_transactions"
    )
    series = demand.own_range_calendar(counts, ["n_transactions"])
    return fc.seasonal_decompose(series, "n_transactions", period)


@query("seasonal_decompose", decompose_sql(7, 60), "trend:8 seasonal:8 residual:8")
def _(spark, sf_dir):
    return decomposed(spark, sf_dir, "weekly", 7)


@query("seasonal_decompose_quarterly", decompose_sql(91, 182), "trend:8 seasonal:8 residual:8")
def _(spark, sf_dir):
    return decomposed(spark, sf_dir, "quarterly", 91)


@query("seasonal_regression")
def _(spark, sf_dir):
    split = stored_split(spark, sf_dir)
    betas = fc.fit_seasonal_regression(fc.part(split, "train"))
    return fc.forecast_metrics(fc.predict_seasonal_regression(fc.part(split, "test"), betas))


@query("seasonal_regression_optimum", S.naive_sql("""
SELECT DISTINCT product, 0.0 AS gradient FROM demand, cut WHERE date < c"""), "gradient:6")
def _(spark, sf_dir):
    """Largest component of the gradient, beside the size of its terms: zero where the fit is the optimum."""
    train = materialise(fc.part(stored_split(spark, sf_dir), "train"), "train")
    terms = fc.SeasonalTerms()
    x = terms.columns()
    rows = train.join(fc.fit_seasonal_regression(train, terms), "product").select(
        "product", "revenue", "beta", F.array(*x).alias("x")
    )
    fitted = " + ".join(f"beta[{i}] * x[{i}]" for i in range(len(x)))
    steep = [
        F.abs(F.expr(f"sum(x[{i}] * (revenue - ({fitted})))"))
        / (1 + F.expr(f"sum(abs(x[{i}] * revenue))"))
        for i in range(len(x))
    ]
    return rows.groupBy("product").agg(F.greatest(*steep).alias("gradient"))


ONE_SPLIT = {"rounds": 1, "depth": 1, "rate": 1.0, "subsample": 1.0, "columns": 1.0}
STUMP_CTES = (
    "learn AS (SELECT demand.*, avg(revenue) OVER (PARTITION BY product) AS base FROM demand, cut WHERE date < c)",
    "long AS (" + " UNION ALL ".join(
        f"SELECT product, base, '{c}' AS f, {c}::DOUBLE AS x, revenue - base AS r FROM learn" for c in demand.MODEL_FEATURES
    ) + ")",
    "sums AS (SELECT product, base, f, x, sum(r) AS s, count(*) AS k FROM long GROUP BY ALL)",
    """upto AS (SELECT *, sum(s) OVER w AS ls, sum(k) OVER w AS lk, lead(x) OVER w AS nx,
  sum(s) OVER v AS ws, sum(k) OVER v AS wk FROM sums
  WINDOW w AS (PARTITION BY product, f ORDER BY x), v AS (PARTITION BY product, f))""",
)


@query("boosted_stump", S.naive_sql("""
SELECT product, base + ls / (lk + 1) AS left_value, base + (ws - ls) / (wk - lk + 1) AS right_value
FROM upto WHERE nx IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY product
  ORDER BY ls * ls / (lk + 1) + (ws - ls) * (ws - ls) / (wk - lk + 1) - ws * ws / (wk + 1) DESC) = 1""", *STUMP_CTES),
       "left_value:6 right_value:6")
def _(spark, sf_dir):
    """One round of one split per product, against trying every threshold of every feature."""
    model = fc.train_demand_gbt(fc.part(stored_split(spark, sf_dir), "train"), ONE_SPLIT)
    leaf = F.col("base") + F.get("value", F.lit(1)), F.col("base") + F.get("value", F.lit(2))
    return model.trees.select("product", leaf[0].alias("left_value"), leaf[1].alias("right_value"))


@query("train_demand_gbt")
def _(spark, sf_dir):
    split = stored_split(spark, sf_dir)
    train = fc.part(split, "train")
    model = fc.train_demand_gbt(train)
    return fc.forecast_metrics(fc.predict_demand(model, train), clip=False)


@query("predict_demand")
def _(spark, sf_dir):
    split = stored_split(spark, sf_dir)
    model = fc.train_demand_gbt(fc.part(split, "train"))
    return fc.predict_demand(model, fc.part(split, "test")).select("product", "date", "prediction")


@query("recursive_forecast_trees")
def _(spark, sf_dir):
    split = stored_split(spark, sf_dir)
    model = fc.train_demand_gbt(fc.part(split, "train"))
    steps = fc.recursive_forecast(split.drop("part"), lambda rows: fc.predict_demand(model, rows), 30)
    spread = fc.residual_spread(fc.predict_demand(model, fc.part(split, "test")))
    return fc.union_horizons(fc.forecast_interval(steps, spread))


@query("tune_demand")
def _(spark, sf_dir):
    return fc.tune_demand(stored_split(spark, sf_dir))


@query("tuned_demand", S.demand_sql("SELECT DISTINCT product, 0.0 AS difference FROM demand"), "difference:8")
def _(spark, sf_dir):
    """The error of the best setting in the search, less the error of the model refitted with it."""
    split, settings = materialise(stored_split(spark, sf_dir), "split"), fc.tuning_settings()
    tuned = materialise(fc.tune_demand(split, settings), "tuned")
    model = fc.train_tuned(fc.part(split, "train"), tuned, settings)
    again = fc.forecast_metrics(fc.predict_demand(model, fc.part(split, "test")))
    both = tuned.select("product", "mape").join(again.select("product", F.col("mape").alias("_again")), "product")
    return both.select("product", F.abs(F.col("mape") - F.col("_again")).alias("difference"))


@query("demand_champion")
def _(spark, sf_dir):
    return fc.demand_leaderboard(fc.demand_candidates(stored_split(spark, sf_dir)))


@query("retrain_metrics")
def _(spark, sf_dir):
    return fc.retrain_errors(stored_demand(spark, sf_dir))
