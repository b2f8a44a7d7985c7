"""Registered queries: descriptive profiles, decisions, top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.operators import cleaning, customers, decisions, profiles
from tallyfold.plans import inputs, sqltext as S
from tallyfold.plans.registry import query
from tallyfold.scratch import materialise

STATS = """stats AS (
  SELECT card, count(datetime) AS frequency, sum(money) AS total_spend, avg(money) AS avg_ticket,
         min(datetime) AS first_purchase, max(datetime) AS last_purchase,
         CAST(floor((epoch_us((SELECT date_trunc('day', max(datetime)) + INTERVAL 1 DAY FROM txn)) - epoch_us(max(datetime))) / 86400000000.0) AS BIGINT) AS recency_days,
         CAST(floor((epoch_us(max(datetime)) - epoch_us(min(datetime))) / 86400000000.0) AS BIGINT) AS tenure_days
  FROM txn WHERE card IS NOT NULL GROUP BY card)"""

BALANCE = """balance AS (
  SELECT window_days, count(*) FILTER (recency_days > window_days) AS churned,
         count(*) FILTER (recency_days <= window_days) AS active,
         round_even(count(*) FILTER (recency_days > window_days) / count(*) * 100, 1) AS churn_rate_pct,
         round_even(least(count(*) FILTER (recency_days > window_days), count(*) FILTER (recency_days <= window_days)) / count(*) * 100, 1) AS minority_pct
  FROM stats, (SELECT unnest([30, 60, 90]) AS window_days) GROUP BY window_days)"""

ACTIVITY = """activity AS (
  SELECT product, CAST(max(date) - min(date) + 1 AS INTEGER) AS n_days,
         count(*) FILTER (n_transactions > 0) AS n_active_days FROM daily_all GROUP BY 1)"""

PRODUCTS = """products AS (
  SELECT coffee_name, count(money) AS volume, sum(money) AS revenue,
         round_even(sum(money) / count(money), 2) AS avg_ticket FROM txn GROUP BY 1)"""

DECIDED = """chosen AS (
  SELECT coalesce((SELECT min(window_days) FROM balance WHERE minority_pct BETWEEN 20 AND 50),
                  (SELECT window_days FROM balance ORDER BY abs(minority_pct - 30), window_days LIMIT 1)) AS window_days),
choice AS (
  SELECT window_days, minority_pct,
         CASE WHEN minority_pct >= 20 THEN 'classification' ELSE 'anomaly_detection' END AS approach
  FROM chosen JOIN balance USING (window_days)),
eligibility AS (
  SELECT count(*) FILTER (n_active_days >= 60) AS n_eligible,
         bool_and(n_days >= 182 AND n_active_days >= n_days * 0.3) AS all_ok FROM activity),
models AS (
  SELECT n_eligible, CASE WHEN n_eligible = 0 THEN ['lag_model']
              WHEN all_ok THEN ['seasonal_regression', 'lag_model', 'seasonal_naive']
              ELSE ['lag_model', 'seasonal_naive', 'seasonal_regression_long_series'] END AS candidates
  FROM eligibility)"""


def sales_sql(body, *more):
    return S.with_ctes(S.SALES, *more, body=body)


def events_sql(body, *more):
    return S.with_ctes(S.EVENTS, *more, body=body)


def stored_stats(spark, sf_dir):
    return materialise(profiles.customer_stats(inputs.sales(spark, sf_dir)), "stats")


def activity(spark, sf_dir):
    return profiles.active_days(inputs.daily(spark, sf_dir))


@query("product_stats", sales_sql("SELECT * FROM products", PRODUCTS), "revenue")
def _(spark, sf_dir):
    return profiles.product_stats(inputs.sales(spark, sf_dir))


@query("payment_mix", sales_sql("""
SELECT cash_type, count(*) AS count, round_even(count(*) / sum(count(*)) OVER () * 100, 1) AS pct FROM txn GROUP BY 1"""))
def _(spark, sf_dir):
    return profiles.share_of_rows(inputs.sales(spark, sf_dir), "cash_type")


@query("identified_share", sales_sql("""
SELECT count(card) AS identified, count(*) - count(card) AS anonymous, count(DISTINCT card) AS customers,
       round_even(count(card) / count(*) * 100, 1) AS identified_pct,
       round_even((count(*) - count(card)) / count(*) * 100, 1) AS anonymous_pct FROM txn"""))
def _(spark, sf_dir):
    return profiles.identified_share(inputs.sales(spark, sf_dir))


HOURLY = "hourly AS (SELECT CAST(hour(datetime) AS INTEGER) AS hour, count(money) AS transactions, sum(money) AS revenue FROM evt GROUP BY 1)"
WEEKDAYS = """weekdays AS (
  SELECT CAST(isodow(datetime) - 1 AS INTEGER) AS day_of_week, count(money) AS transactions, sum(money) AS revenue,
         ['Seg', 'Ter', 'Qua', 'Qui', 'Sex', 'Sáb', 'Dom'][isodow(datetime)] AS day_name
  FROM evt GROUP BY ALL)"""


@query("hourly_profile", events_sql("SELECT * FROM hourly", HOURLY), "revenue")
def _(spark, sf_dir):
    return profiles.hourly_profile(inputs.events(spark, sf_dir))


@query("weekday_profile", events_sql("SELECT * FROM weekdays", WEEKDAYS), "revenue")
def _(spark, sf_dir):
    return profiles.weekday_profile(inputs.events(spark, sf_dir))


@query("monthly_profile", sales_sql("""
SELECT CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month,
       count(money) AS transactions, sum(money) AS revenue, strftime(any_value(datetime), '%Y-%m') AS period
FROM txn GROUP BY 1, 2"""), "revenue")
def _(spark, sf_dir):
    return profiles.monthly_profile(inputs.sales(spark, sf_dir))


@query("peak_hour", events_sql("SELECT hour, transactions FROM hourly ORDER BY transactions DESC, hour LIMIT 1", HOURLY))
def _(spark, sf_dir):
    return profiles.busiest(profiles.hourly_profile(inputs.events(spark, sf_dir)), "hour")


@query("peak_weekday", events_sql("""
SELECT day_of_week, transactions FROM weekdays ORDER BY transactions DESC, day_of_week LIMIT 1""", WEEKDAYS))
def _(spark, sf_dir):
    return profiles.busiest(profiles.weekday_profile(inputs.events(spark, sf_dir)), "day_of_week")


@query("customer_stats", sales_sql("""
SELECT * REPLACE (round(avg_ticket * frequency, 4) / frequency AS avg_ticket) FROM stats""", STATS), "total_spend")
def _(spark, sf_dir):
    stats = profiles.customer_stats(inputs.sales(spark, sf_dir))
    # A mean of many amounts may fall halfway between any two decimals, so its sum is rounded.
    n = F.col("frequency")
    return stats.withColumn("avg_ticket", F.round(F.col("avg_ticket") * n, 4) / n)


@query("customer_summary", sales_sql("""
SELECT count(*) AS customers, avg(frequency) AS mean_frequency, avg(avg_ticket) AS mean_ticket,
       quantile_cont(recency_days, 0.5) AS median_recency,
       count(*) FILTER (frequency = 1) AS one_purchase, count(*) FILTER (frequency >= 5) AS five_or_more FROM stats""", STATS),
    "mean_frequency:8 mean_ticket:8")
def _(spark, sf_dir):
    return profiles.customer_summary(stored_stats(spark, sf_dir))


def describe_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
            CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25,
            quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75 FROM {source}"""
        for c in columns
    )


@query("describe_numeric", S.rfm_sql(describe_sql("rfm", ["recency_days", "frequency", "monetary"])),
       "mean:7 std:6 min max p25:7 p50:7 p75:7")
def _(spark, sf_dir):
    return profiles.describe_numeric(inputs.rfm(spark, sf_dir), customers.RFM_RAW)


@query("describe_money", events_sql(describe_sql("evt", ["money"])), "mean:7 std:6 p25:7 p50:7 p75:7")
def _(spark, sf_dir):
    return profiles.describe_numeric(inputs.events(spark, sf_dir), ["money"])


@query("histogram", events_sql("""
SELECT CAST(least(floor((money - lo) / (hi - lo) * 50) + 1, 50) AS INTEGER) AS bin, count(*) AS n
FROM evt, (SELECT min(money) AS lo, max(money) AS hi FROM evt) GROUP BY 1"""))
def _(spark, sf_dir):
    return profiles.histogram(inputs.events(spark, sf_dir), "money", 50)


@query("histogram_frequency", S.rfm_sql("""
SELECT CAST(least(floor((frequency - lo) / CAST(hi - lo AS DOUBLE) * 40) + 1, 40) AS INTEGER) AS bin, count(*) AS n
FROM rfm, (SELECT min(frequency) AS lo, max(frequency) AS hi FROM rfm) GROUP BY 1"""))
def _(spark, sf_dir):
    return profiles.histogram(inputs.rfm(spark, sf_dir), "frequency", 40)


GAPS = """gaps AS (
  SELECT card, day, day - lag(day) OVER (PARTITION BY card ORDER BY day) AS ipi_days
  FROM (SELECT DISTINCT card, CAST(datetime AS DATE) AS day FROM txn WHERE card IS NOT NULL)),
ipi AS (SELECT card, day, CAST(ipi_days AS INTEGER) AS ipi_days FROM gaps WHERE ipi_days IS NOT NULL)"""


@query("day_diff", sales_sql("SELECT card, day, ipi_days FROM ipi", GAPS))
def _(spark, sf_dir):
    return profiles.purchase_intervals(inputs.sales(spark, sf_dir))


@query("ipi_distribution", sales_sql(describe_sql("ipi", ["ipi_days"]), GAPS), "mean:7 std:6")
def _(spark, sf_dir):
    return profiles.describe_numeric(
        profiles.purchase_intervals(inputs.sales(spark, sf_dir)), ["ipi_days"]
    )


@query("ipi_histogram", sales_sql("""
SELECT CAST(least(floor(ipi_days / 120.0 * 60) + 1, 60) AS INTEGER) AS bin, count(*) AS n
FROM ipi WHERE ipi_days BETWEEN 0 AND 120 GROUP BY 1""", GAPS))
def _(spark, sf_dir):
    gaps = profiles.purchase_intervals(inputs.sales(spark, sf_dir))
    return profiles.histogram(gaps, "ipi_days", 60, 0, 120)


@query("distinct_purchase_days", sales_sql("""
SELECT DISTINCT card, CAST(datetime AS DATE) AS day FROM txn WHERE card IS NOT NULL"""))
def _(spark, sf_dir):
    return profiles.purchase_days(inputs.sales(spark, sf_dir))


@query("active_days", sales_sql("SELECT * FROM activity", S.DAILY_ALL, ACTIVITY))
def _(spark, sf_dir):
    return activity(spark, sf_dir)


@query("forecast_eligible", sales_sql("SELECT * FROM activity WHERE n_active_days >= 60", S.DAILY_ALL, ACTIVITY))
def _(spark, sf_dir):
    return decisions.forecast_eligible(activity(spark, sf_dir))


@query("ineligible_anti", sales_sql("""
SELECT product FROM activity WHERE product NOT IN (
  SELECT product FROM activity WHERE n_active_days >= (SELECT avg(n_active_days) FROM activity))""", S.DAILY_ALL, ACTIVITY))
def _(spark, sf_dir):
    days = materialise(activity(spark, sf_dir), "activity")
    above = days.where(F.col("n_active_days") >= days.agg(F.avg("n_active_days")).scalar())
    return decisions.ineligible_anti(days.select("product"), above)


@query("series_viability", sales_sql("""
SELECT *, CASE WHEN n_days < 182 OR n_active_days < n_days * 0.3 THEN 'skipped' ELSE 'ok' END AS status,
       CASE WHEN n_days < 182 THEN 'too_short' WHEN n_active_days < n_days * 0.3 THEN 'too_many_empty_days' END AS reason
FROM activity""", S.DAILY_ALL, ACTIVITY))
def _(spark, sf_dir):
    return decisions.series_viability(activity(spark, sf_dir), "quarterly")


@query("churn_balance", sales_sql("SELECT * FROM balance", STATS, BALANCE))
def _(spark, sf_dir):
    return decisions.churn_balance(profiles.customer_stats(inputs.sales(spark, sf_dir)))


@query("choose_churn_window", sales_sql("SELECT window_days, minority_pct, approach FROM choice",
                                        STATS, BALANCE, S.DAILY_ALL, ACTIVITY, DECIDED))
def _(spark, sf_dir):
    stats = profiles.customer_stats(inputs.sales(spark, sf_dir))
    return decisions.choose_churn_window(decisions.churn_balance(stats))


@query("clustering_viable", sales_sql("SELECT count(*) AS customers, count(*) >= 50 AS clustering_viable FROM stats", STATS))
def _(spark, sf_dir):
    return decisions.clustering_viable(profiles.customer_stats(inputs.sales(spark, sf_dir)))


@query("forecast_candidates", sales_sql("SELECT n_eligible, candidates FROM models",
                                        STATS, BALANCE, S.DAILY_ALL, ACTIVITY, DECIDED))
def _(spark, sf_dir):
    return decisions.forecast_candidates(activity(spark, sf_dir))


@query("decision_log", sales_sql("""
SELECT window_days AS churn_window_days, approach AS churn_approach,
       (SELECT list(product ORDER BY product) FROM activity WHERE n_active_days >= 60) AS forecast_products,
       candidates AS forecast_candidates, (SELECT count(*) FROM stats) AS identified_customers,
       (SELECT count(*) FROM stats) >= 50 AS clustering_viable
FROM choice, models""", STATS, BALANCE, S.DAILY_ALL, ACTIVITY, DECIDED))
def _(spark, sf_dir):
    days = materialise(activity(spark, sf_dir), "activity")
    return decisions.decision_log(stored_stats(spark, sf_dir), days)


@query("segment_counts", S.scored_sql("""
SELECT segment_name, count(*) AS count, round_even(count(*) / sum(count(*)) OVER () * 100, 1) AS pct FROM scored GROUP BY 1"""))
def _(spark, sf_dir):
    return profiles.share_of_rows(inputs.scored(spark, sf_dir), "segment_name")


@query("segment_profile", S.scored_sql("""
SELECT segment_name, round_even(quantile_cont(CAST(recency_days AS DOUBLE), 0.5), 1) AS recency_days,
       round_even(quantile_cont(CAST(frequency AS DOUBLE), 0.5), 1) AS frequency,
       round_even(quantile_cont(monetary, 0.5), 1) AS monetary, count(*) AS size FROM scored GROUP BY 1"""))
def _(spark, sf_dir):
    return profiles.segment_profile(inputs.scored(spark, sf_dir), "segment_name", customers.RFM_RAW)


@query("cluster_profile_join", S.scored_sql("""
SELECT cluster_id, round_even(quantile_cont(CAST(recency_days AS DOUBLE), 0.5), 1) AS recency_days,
       round_even(quantile_cont(CAST(frequency AS DOUBLE), 0.5), 1) AS frequency,
       round_even(quantile_cont(monetary, 0.5), 1) AS monetary, count(*) AS size FROM segments GROUP BY 1""", S.SEGMENTS))
def _(spark, sf_dir):
    return profiles.segment_profile(inputs.segments(spark, sf_dir), "cluster_id", customers.RFM_RAW)


@query("class_distribution", S.with_ctes(S.SALES, S.behaviour(), body="""
SELECT count(*) FILTER (churn = 0) AS n_neg, count(*) FILTER (churn = 1) AS n_pos,
       count(*) FILTER (churn = 0) / count(*) AS neg_share, count(*) FILTER (churn = 1) / count(*) AS pos_share,
       count(*) FILTER (churn = 0) / count(*) FILTER (churn = 1) AS neg_per_pos FROM beh"""),
    "neg_share:9 pos_share:9 neg_per_pos:9")
def _(spark, sf_dir):
    return profiles.class_distribution(customers.behaviour(inputs.sales(spark, sf_dir)))


CLASS_FEATURES = [*customers.RFM_RAW, *customers.RFM_NORM, "freq_last_4w", "freq_last_8w",
                  "avg_ticket_recent", "n_distinct_products", "days_since_first_purchase"]


@query("class_means", S.churn_sql(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, avg({c}) FILTER (churn = 0) AS active_mean, avg({c}) FILTER (churn = 1) AS churned_mean,
       round_even((avg({c}) FILTER (churn = 0) - avg({c}) FILTER (churn = 1)) / nullif(avg({c}) FILTER (churn = 0), 0) * 100, 1) AS diff_pct
FROM churnfeat""" for c in CLASS_FEATURES)), "active_mean:6 churned_mean:6")
def _(spark, sf_dir):
    return profiles.class_means(inputs.churn_table(spark, sf_dir), CLASS_FEATURES)


@query("correlation_matrix", S.rfm_sql(" UNION ALL ".join(
    f"SELECT '{a}' AS feature, " + ", ".join(f"corr({a}, {b}) AS {b}" for b in customers.RFM_NORM) + " FROM rfm"
    for a in customers.RFM_NORM)), "recency_norm:9 frequency_norm:9 monetary_norm:9")
def _(spark, sf_dir):
    return profiles.correlation_matrix(inputs.rfm(spark, sf_dir), customers.RFM_NORM)


@query("revenue_by_product_total", sales_sql("SELECT coffee_name AS product, sum(money) AS revenue FROM txn GROUP BY 1"), "revenue")
def _(spark, sf_dir):
    return profiles.revenue_by_product(inputs.sales(spark, sf_dir))


@query("kpi_totals", sales_sql("""
SELECT sum(money) AS revenue, avg(money) AS avg_ticket, count(*) AS transactions, count(DISTINCT coffee_name) AS products FROM txn"""),
    "revenue:3 avg_ticket:6")
def _(spark, sf_dir):
    return profiles.kpi_totals(inputs.sales(spark, sf_dir))


@query("daily_avg_revenue", sales_sql("""
SELECT avg(revenue) AS daily_avg_revenue FROM (SELECT sum(money) AS revenue FROM txn GROUP BY CAST(datetime AS DATE))"""),
    "daily_avg_revenue:5")
def _(spark, sf_dir):
    return profiles.daily_average_revenue(inputs.sales(spark, sf_dir))


TOP_BOTTOM = """SELECT *, 'top' AS side FROM (SELECT * FROM products ORDER BY {m} DESC, coffee_name LIMIT 5)
UNION ALL SELECT *, 'bottom' FROM (SELECT * FROM products ORDER BY {m}, coffee_name DESC LIMIT 5)"""


@query("top_bottom_volume", sales_sql(TOP_BOTTOM.format(m="volume"), PRODUCTS), "revenue")
def _(spark, sf_dir):
    return profiles.top_and_bottom(profiles.product_stats(inputs.sales(spark, sf_dir)), "volume", "coffee_name")


@query("top_bottom_revenue", sales_sql(TOP_BOTTOM.format(m="revenue"), PRODUCTS), "revenue")
def _(spark, sf_dir):
    return profiles.top_and_bottom(profiles.product_stats(inputs.sales(spark, sf_dir)), "revenue", "coffee_name")


@query("top_products_by_revenue", """
SELECT p_brand || ' ' || p_type AS coffee_name, count(*) AS volume, sum(l_extendedprice * (1 - l_discount)) AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY revenue DESC, coffee_name LIMIT 10""", "revenue")
def _(spark, sf_dir):
    from tallyfold.sources.adapters import table

    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    sales = lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.concat_ws(" ", "p_brand", "p_type").alias("coffee_name"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("money"),
    )
    stats = profiles.product_stats(sales).drop("avg_ticket")
    return profiles.top_n(stats, "revenue", "coffee_name", 10)


@query("top_series_products", sales_sql("SELECT coffee_name, volume FROM products ORDER BY volume DESC, coffee_name LIMIT 5", PRODUCTS))
def _(spark, sf_dir):
    stats = profiles.product_stats(inputs.sales(spark, sf_dir)).select("coffee_name", "volume")
    return profiles.top_n(stats, "volume", "coffee_name", 5)


@query("product_whitelist_table", sales_sql("""
SELECT coffee_name, count(*) AS n FROM txn WHERE coffee_name IN (SELECT coffee_name FROM products ORDER BY volume DESC, coffee_name LIMIT 5)
GROUP BY 1""", PRODUCTS))
def _(spark, sf_dir):
    sales = inputs.sales(spark, sf_dir)
    best = profiles.top_n(profiles.product_stats(sales), "volume", "coffee_name", 5)
    return cleaning.product_whitelist(sales, best).groupBy("coffee_name").agg(F.count("*").alias("n"))
