"""Registered queries: sources, sinks, cleaning and the feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import numeric, temporal
from tallyfold.operators import cleaning, customers, demand, ordering
from tallyfold.plans import inputs, sqltext as S
from tallyfold.plans.registry import query
from tallyfold.schemas import available_columns, require_columns
from tallyfold.scratch import scratch_path
from tallyfold.sources import adapters, files

BY_SOURCE_SQL = """SELECT cash_type, coffee_name, count(*) AS n, count(card) AS n_card, sum(money) AS money
FROM txn {where} GROUP BY ALL"""


def by_source(df: DataFrame) -> DataFrame:
    return df.groupBy("cash_type", "coffee_name").agg(
        F.count("*").alias("n"), F.count("card").alias("n_card"),
        F.sum(F.col("money").cast("double")).alias("money"),
    )


def write_sources(spark, sf_dir) -> tuple[str, str]:
    """Source A holds card sales, source B cash sales without a card column."""
    sales = inputs.sales(spark, sf_dir)
    paths = scratch_path(spark, "source-a"), scratch_path(spark, "source-b")
    files.sink_csv(sales.where(F.col("cash_type") == "card"), paths[0])
    files.sink_csv(sales.where(F.col("cash_type") == "cash").drop("card"), paths[1])
    return paths


@query("scan_csv", S.with_ctes(S.SALES, body=BY_SOURCE_SQL.format(where="")), "money")
def _(spark, sf_dir):
    path = scratch_path(spark, "one-source")
    files.sink_csv(inputs.sales(spark, sf_dir), path)
    return by_source(files.scan_csv(spark, path))


@query("scan_merge_sources", S.with_ctes(S.SALES, body=BY_SOURCE_SQL.format(where="")), "money")
def _(spark, sf_dir):
    absent = scratch_path(spark, "absent")
    return by_source(files.scan_merge_sources(spark, [*write_sources(spark, sf_dir), absent]))


@query("union_sources", S.with_ctes(S.SALES, body=BY_SOURCE_SQL.format(where="")), "money")
def _(spark, sf_dir):
    sales = inputs.sales(spark, sf_dir)
    return by_source(
        files.union_sources(
            [sales.where("cash_type = 'card'"), sales.where("cash_type = 'cash'").drop("card")]
        )
    )


@query("ingest", S.with_ctes(S.SALES, body=BY_SOURCE_SQL.format(where="")), "money")
def _(spark, sf_dir):
    stored = scratch_path(spark, "validated")
    cleaning.ingest(spark, stored, raw_paths=write_sources(spark, sf_dir))
    return by_source(files.scan_csv(spark, stored))


EVENT_ROWS_SQL = S.with_ctes(
    S.EVENTS, body="SELECT datetime, cash_type, card, money, coffee_name FROM evt"
)


@query("sink_csv", EVENT_ROWS_SQL)
def _(spark, sf_dir):
    path = files.sink_csv(inputs.events(spark, sf_dir), scratch_path(spark, "csv"))
    return cleaning.coerce_types(files.scan_csv(spark, path))


@query("sink_parquet", EVENT_ROWS_SQL)
def _(spark, sf_dir):
    path = files.sink_parquet(inputs.events(spark, sf_dir), scratch_path(spark, "parquet"))
    return files.scan_parquet(spark, path)


@query("scan_parquet", "SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1", "total")
def _(spark, sf_dir):
    orders = files.scan_parquet(spark, f"{sf_dir}/orders.parquet")
    return orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("total")
    )


@query("scan_with_fallback", EVENT_ROWS_SQL)
def _(spark, sf_dir):
    raw = files.sink_csv(inputs.events(spark, sf_dir), scratch_path(spark, "csv"))
    return files.scan_with_fallback(spark, scratch_path(spark, "absent"), raw)


@query("reuse_or_build", S.with_ctes(S.SALES, S.DAILY, S.GRID, body="SELECT * FROM grid"), "revenue")
def _(spark, sf_dir):
    path = scratch_path(spark, "daily-demand")

    def build() -> DataFrame:
        return demand.daily_demand(inputs.sales(spark, sf_dir), adapters.FORECAST_TYPES)

    files.reuse_or_build(spark, path, build)
    return files.reuse_or_build(spark, path, build)


@query("txn_view", S.with_ctes(S.EVENTS, body="""
SELECT *, CAST(datetime AS DATE) AS date, CAST(hour(datetime) AS INTEGER) AS hour,
       CAST(isodow(datetime) - 1 AS INTEGER) AS day_of_week, dayname(datetime) AS day_name FROM evt"""))
def _(spark, sf_dir):
    return adapters.sales_view(inputs.events(spark, sf_dir))


RAW_EVENTS_SQL = """raw AS (
  SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN
           CASE WHEN event_type = 'click' THEN date_trunc('second', ts) ELSE ts END END AS datetime,
         CASE WHEN event_type = 'view' THEN 'voucher' ELSE 'card' END AS cash_type,
         CAST(user_id AS VARCHAR) AS card, value - 5 AS money,
         CASE WHEN event_type <> 'signup' THEN event_type END AS coffee_name
  FROM events)"""


@query("validate_schema", S.with_ctes(RAW_EVENTS_SQL, body="""
SELECT 'datetime_not_null' AS rule, count(*) FILTER (datetime IS NULL) AS n_bad FROM raw
UNION ALL SELECT 'cash_type_not_null', count(*) FILTER (cash_type IS NULL) FROM raw
UNION ALL SELECT 'cash_type_known', count(*) FILTER (cash_type NOT IN ('card', 'cash')) FROM raw
UNION ALL SELECT 'money_not_null', count(*) FILTER (money IS NULL) FROM raw
UNION ALL SELECT 'money_positive', count(*) FILTER (money <= 0) FROM raw
UNION ALL SELECT 'coffee_name_not_null', count(*) FILTER (coffee_name IS NULL) FROM raw"""))
def _(spark, sf_dir):
    return cleaning.schema_violations(inputs.raw_events(spark, sf_dir))


@query("parse_datetime", S.with_ctes(RAW_EVENTS_SQL, body="""
SELECT event_id, datetime FROM raw WHERE datetime IS NOT NULL"""))
def _(spark, sf_dir):
    return cleaning.parse_datetime(inputs.raw_events(spark, sf_dir)).select("event_id", "datetime")


TEMPORAL_SQL = """CAST(hour(datetime) AS TINYINT) AS hour, CAST(isodow(datetime) - 1 AS TINYINT) AS day_of_week,
       CAST(week(datetime) AS TINYINT) AS week_of_year, CAST(month(datetime) AS TINYINT) AS month,
       CAST(year(datetime) AS SMALLINT) AS year, isodow(datetime) >= 6 AS is_weekend,
       CASE WHEN hour(datetime) BETWEEN 6 AND 11 THEN 'morning' WHEN hour(datetime) BETWEEN 12 AND 17 THEN 'afternoon'
            WHEN hour(datetime) BETWEEN 18 AND 20 THEN 'evening' ELSE 'night' END AS time_of_day_bucket"""


@query("temporal_features", S.with_ctes(S.EVENTS, body=f"SELECT *, {TEMPORAL_SQL} FROM evt"))
def _(spark, sf_dir):
    return cleaning.temporal_features(inputs.events(spark, sf_dir))


@query("time_of_day_bucket", S.with_ctes(S.EVENTS, body=f"""
SELECT time_of_day_bucket, count(*) AS n, sum(money) AS money
FROM (SELECT money, {TEMPORAL_SQL} FROM evt) GROUP BY 1"""), "money")
def _(spark, sf_dir):
    rows = inputs.events(spark, sf_dir)
    bucket = temporal.day_part(F.hour("datetime")).alias("time_of_day_bucket")
    return rows.groupBy(bucket).agg(F.count("*").alias("n"), F.sum("money").alias("money"))


@query("remove_invalid_rows", S.with_ctes(RAW_EVENTS_SQL, body="""
SELECT event_id, money, coffee_name FROM raw WHERE money > 0 AND coffee_name IS NOT NULL"""), "money")
def _(spark, sf_dir):
    rows = cleaning.coerce_types(inputs.raw_events(spark, sf_dir))
    return cleaning.remove_invalid_rows(rows).select("event_id", "money", "coffee_name")


IQR_SQL = """fence AS (
  SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
  FROM (SELECT quantile_cont(money, 0.25) AS q1, quantile_cont(money, 0.75) AS q3 FROM {source}))"""


@query("iqr_outlier_filter", S.with_ctes(S.EVENTS, IQR_SQL.format(source="evt"), body="""
SELECT evt.* FROM evt, fence WHERE money BETWEEN lower AND upper"""))
def _(spark, sf_dir):
    return cleaning.iqr_outlier_filter(inputs.events(spark, sf_dir))


@query("normalise_card", S.with_ctes(S.EVENTS, body="""
SELECT coalesce(card, 'anonymous') AS card, count(*) AS n, sum(money) AS money FROM evt GROUP BY 1"""), "money")
def _(spark, sf_dir):
    return cleaning.normalise_card(inputs.events(spark, sf_dir)).groupBy("card").agg(
        F.count("*").alias("n"), F.sum("money").alias("money")
    )


@query("preprocess", S.with_ctes(RAW_EVENTS_SQL, """valid AS (
  SELECT * FROM raw WHERE datetime IS NOT NULL AND money > 0 AND coffee_name IS NOT NULL)""",
    IQR_SQL.format(source="valid"), body=f"""
SELECT event_id, datetime, cash_type, coalesce(card, 'anonymous') AS card, money, coffee_name, {TEMPORAL_SQL}
FROM valid, fence WHERE money BETWEEN lower AND upper"""), "money")
def _(spark, sf_dir):
    raw = inputs.raw_events(spark, sf_dir).withColumn("money", F.col("money").cast("double"))
    return cleaning.preprocess(raw)


@query("identified_filter", S.with_ctes(S.SALES, body="""
SELECT card, count(*) AS n FROM txn WHERE card IS NOT NULL AND card <> 'anonymous' GROUP BY 1"""))
def _(spark, sf_dir):
    named = cleaning.normalise_card(inputs.sales(spark, sf_dir))
    return cleaning.identified(named).groupBy("card").agg(F.count("*").alias("n"))


@query("product_whitelist", S.with_ctes(S.SALES, body=f"""
SELECT coffee_name, count(*) AS n, sum(money) AS money FROM txn WHERE coffee_name IN {S.WHITELIST} GROUP BY 1"""), "money")
def _(spark, sf_dir):
    kept = cleaning.product_whitelist(inputs.sales(spark, sf_dir), adapters.FORECAST_TYPES)
    return kept.groupBy("coffee_name").agg(F.count("*").alias("n"), F.sum("money").alias("money"))


@query("date_range_filter", S.with_ctes(S.SALES, body="""
SELECT CAST(datetime AS DATE) AS date, count(*) AS n FROM txn
WHERE CAST(datetime AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1999-06-30' GROUP BY 1"""))
def _(spark, sf_dir):
    view = adapters.sales_view(inputs.sales(spark, sf_dir))
    return cleaning.date_range(view, "1997-03-01", "1999-06-30").groupBy("date").agg(
        F.count("*").alias("n")
    )


@query("calendar_features", S.with_ctes(S.SALES, S.DAILY_ALL, body="""
SELECT product, date, CAST(isodow(date) - 1 AS TINYINT) AS day_of_week,
       CAST(isodow(date) >= 6 AS TINYINT) AS is_weekend, CAST(month(date) AS TINYINT) AS month FROM daily_all"""))
def _(spark, sf_dir):
    days = inputs.daily(spark, sf_dir).select("product", "date")
    return cleaning.calendar_features(days)


@query("mask_card", S.rfm_sql("SELECT card, '****' || right(card, 4) AS masked FROM rfm"))
def _(spark, sf_dir):
    return inputs.rfm(spark, sf_dir).select("card", numeric.masked_card(F.col("card")).alias("masked"))


@query("label_map", S.with_ctes(S.SALES, body="""
SELECT DISTINCT year(datetime) || '-' || lpad(CAST(month(datetime) AS VARCHAR), 2, '0') AS period,
       dayname(datetime) AS day_name FROM txn"""))
def _(spark, sf_dir):
    ts = F.col("datetime")
    return inputs.sales(spark, sf_dir).select(
        temporal.month_label(F.year(ts), F.month(ts)).alias("period"),
        temporal.day_name(F.weekday(ts)).alias("day_name"),
    ).distinct()


@query("bubble_size", S.rfm_sql("SELECT card, pow(greatest(monetary, 1), 0.4) AS size FROM rfm"), "size")
def _(spark, sf_dir):
    return inputs.rfm(spark, sf_dir).select("card", numeric.bubble_size(F.col("monetary")).alias("size"))


@query("currency_fmt", S.with_ctes(S.SALES, body="""
SELECT coffee_name, 'R$ ' || format('{:,.2f}', sum(money)) AS revenue FROM txn GROUP BY 1"""))
def _(spark, sf_dir):
    totals = inputs.sales(spark, sf_dir).groupBy("coffee_name").agg(F.sum("money").alias("money"))
    return totals.select("coffee_name", numeric.currency(F.col("money")).alias("revenue"))


@query("clip_nonnegative", S.demand_sql("""
SELECT product, date, greatest(2 * lag_1 - lag_7, 0.0) AS prediction FROM demand"""), "prediction")
def _(spark, sf_dir):
    trend = 2 * F.col("lag_1") - F.col("lag_7")
    return inputs.demand_table(spark, sf_dir).select(
        "product", "date", numeric.clip_at_zero(trend).alias("prediction")
    )


@query("feature_availability", S.rfm_sql("SELECT card, recency_days, monetary FROM rfm"), "monetary")
def _(spark, sf_dir):
    rfm = inputs.rfm(spark, sf_dir)
    return rfm.select("card", *available_columns(rfm, ["recency_days", "visits", "monetary"]))


@query("require_columns", S.demand_sql("""
SELECT product, date, lag_1, lag_7, lag_14, rolling_mean_7, rolling_mean_14, day_of_week, is_weekend, month FROM demand"""),
    "lag_1 lag_7 lag_14 rolling_mean_7:7 rolling_mean_14:7")
def _(spark, sf_dir):
    table = require_columns(inputs.demand_table(spark, sf_dir), [*demand.MODEL_FEATURES, "revenue"])
    return table.select("product", "date", *demand.MODEL_FEATURES)


DEMAND_DOUBLES = "revenue lag_1 lag_7 lag_14 rolling_mean_7:7 rolling_mean_14:7"


@query("cross_calendar", S.with_ctes(S.SALES, S.DAILY, S.GRID, body="SELECT product, date, revenue, n_transactions FROM grid"), "revenue")
@query("daily_demand", S.with_ctes(S.SALES, S.DAILY, S.GRID, body="SELECT * FROM grid"), "revenue")
def _(spark, sf_dir):
    return demand.daily_demand(inputs.sales(spark, sf_dir), adapters.FORECAST_TYPES)


@query("own_range_calendar", S.with_ctes(S.SALES, S.DAILY_ALL, S.OWN_GRID, body="SELECT * FROM own_grid"), "revenue")
def _(spark, sf_dir):
    return demand.own_range_calendar(inputs.daily(spark, sf_dir))


@query("lag_features", S.demand_sql("SELECT product, date, revenue, lag_1, lag_7, lag_14 FROM demand"), "revenue lag_1 lag_7 lag_14")
def _(spark, sf_dir):
    days = demand.daily_demand(inputs.sales(spark, sf_dir), adapters.FORECAST_TYPES)
    return demand.lag_features(days).drop("n_transactions")


@query("rolling_features", S.demand_sql("SELECT product, date, revenue, rolling_mean_7, rolling_mean_14 FROM demand"),
       "revenue rolling_mean_7:7 rolling_mean_14:7")
def _(spark, sf_dir):
    days = demand.daily_demand(inputs.sales(spark, sf_dir), adapters.FORECAST_TYPES)
    return demand.rolling_features(days).drop("n_transactions")


@query("demand_features", S.demand_sql("SELECT * FROM demand"), DEMAND_DOUBLES)
def _(spark, sf_dir):
    return inputs.demand_table(spark, sf_dir)


@query("distinct_products", S.with_ctes(S.SALES, body="SELECT DISTINCT coffee_name FROM txn"))
def _(spark, sf_dir):
    return inputs.sales(spark, sf_dir).select("coffee_name").distinct()


@query("moving_avg_strict", S.with_ctes(S.SALES, S.DAILY_ALL, body="""
SELECT product, date, revenue, CASE WHEN count(*) OVER w = 7 THEN avg(revenue) OVER w END AS ma7 FROM daily_all
WINDOW w AS (PARTITION BY product ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""), "revenue ma7:6")
def _(spark, sf_dir):
    days = inputs.daily(spark, sf_dir).drop("n_transactions")
    return demand.moving_average(days, "revenue", strict=True)


@query("moving_avg_partial", S.with_ctes(S.SALES, S.DAILY_ALL, S.OWN_GRID, body="""
SELECT product, date, n_transactions, avg(n_transactions) OVER (
  PARTITION BY product ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7 FROM own_grid"""), "ma7:8")
def _(spark, sf_dir):
    counts = inputs.daily(spark, sf_dir).select("product", "date", "n_transactions")
    return demand.moving_average(
        demand.own_range_calendar(counts, ["n_transactions"]), "n_transactions"
    )


@query("position_split", S.demand_sql("""
SELECT product, date, revenue,
       CASE WHEN row_number() OVER (ORDER BY product, date) <= count(*) OVER () // 2 THEN 'reference' ELSE 'current' END AS side
FROM demand"""), "revenue")
def _(spark, sf_dir):
    split = demand.halves(inputs.demand_table(spark, sf_dir), "position")
    return split.select("product", "date", "revenue", "side")


@query("last60_history", S.with_ctes(S.SALES, S.DAILY_ALL, body="""
SELECT product, date, revenue FROM daily_all
QUALIFY date >= max(date) OVER (PARTITION BY product) - 60"""), "revenue")
def _(spark, sf_dir):
    return demand.recent_history(inputs.daily(spark, sf_dir)).select("product", "date", "revenue")


@query("last60_rows", S.demand_sql("""
SELECT product, date, revenue FROM demand
QUALIFY row_number() OVER (PARTITION BY product ORDER BY date DESC) <= 60"""), "revenue")
def _(spark, sf_dir):
    return demand.recent_rows(inputs.demand_table(spark, sf_dir)).select("product", "date", "revenue")


RFM_DOUBLES = "monetary recency_norm:9 frequency_norm:9 monetary_norm:9"


@query("rfm_features", S.rfm_sql("SELECT * FROM rfm"), RFM_DOUBLES)
def _(spark, sf_dir):
    return inputs.rfm(spark, sf_dir)


@query("rfm_features_events", S.with_ctes(S.EVENTS, S.rfm("evt"), body="SELECT * FROM rfm"), RFM_DOUBLES)
def _(spark, sf_dir):
    return customers.rfm_features(inputs.events(spark, sf_dir))


@query("minmax_norm", S.with_ctes(S.SALES, S.DAILY_ALL, """p AS (
  SELECT product, sum(revenue) AS revenue, sum(n_transactions) AS n FROM daily_all GROUP BY 1)""", body="""
SELECT product, (revenue - min(revenue) OVER ()) / (max(revenue) OVER () - min(revenue) OVER ()) AS revenue_norm,
       1 - (n - min(n) OVER ()) / CAST(max(n) OVER () - min(n) OVER () AS DOUBLE) AS n_norm FROM p"""), "revenue_norm n_norm", 9)
def _(spark, sf_dir):
    totals = inputs.daily(spark, sf_dir).groupBy("product").agg(
        F.sum("revenue").alias("revenue"), F.sum("n_transactions").alias("n")
    )
    scaled = customers.minmax_columns(totals, {"revenue": "revenue_norm", "n": "n_norm"}, ("n",))
    return scaled.select("product", "revenue_norm", "n_norm")


@query("broadcast_scalar", S.with_ctes(S.EVENTS, body="""
SELECT card, CAST(floor((epoch_us(date_trunc('day', (SELECT max(datetime) FROM evt))) - epoch_us(max(datetime))) / 86400000000.0) AS BIGINT) AS days_ago
FROM evt WHERE card IS NOT NULL GROUP BY 1"""))
def _(spark, sf_dir):
    rows = inputs.events(spark, sf_dir)
    reference = temporal.day_start(rows.agg(F.max("datetime")).scalar())
    last = cleaning.identified(rows).groupBy("card").agg(F.max("datetime").alias("last"))
    return last.select("card", temporal.floor_days(reference, F.col("last")).alias("days_ago"))


@query("rank_first", S.rfm_sql("""
SELECT card, row_number() OVER (ORDER BY frequency, card) AS rank_up,
       row_number() OVER (ORDER BY recency_days DESC, card) AS rank_down FROM rfm"""))
def _(spark, sf_dir):
    rfm = inputs.rfm(spark, sf_dir).select("card", "frequency", (-F.col("recency_days")).alias("fresh"))
    up = ordering.global_rank(rfm, ["frequency", "card"], name="rank_up")
    return ordering.global_rank(up, ["fresh", "card"], name="rank_down").select(
        "card", "rank_up", "rank_down"
    )


@query("rfm_quintiles", S.scored_sql("SELECT * FROM scored"), RFM_DOUBLES)
def _(spark, sf_dir):
    return inputs.scored(spark, sf_dir)


BEHAVIOUR_COLUMNS = """card, churn, freq_last_4w, freq_last_8w, avg_ticket_recent,
       n_distinct_products, days_since_first_purchase"""


@query("join_recent_behaviour", S.with_ctes(S.SALES, S.behaviour(), body=f"SELECT {BEHAVIOUR_COLUMNS} FROM beh"), "avg_ticket_recent:7")
def _(spark, sf_dir):
    return customers.behaviour(inputs.sales(spark, sf_dir))


@query("churn_behaviour_events", S.with_ctes(S.EVENTS, S.behaviour(7, "evt"), body=f"SELECT {BEHAVIOUR_COLUMNS} FROM beh"), "avg_ticket_recent:8")
def _(spark, sf_dir):
    return customers.behaviour(inputs.events(spark, sf_dir), window_days=7)


@query("churn_label", S.with_ctes(S.SALES, S.behaviour(60), body="SELECT card, churn FROM beh"))
def _(spark, sf_dir):
    return customers.behaviour(inputs.sales(spark, sf_dir), window_days=60).select("card", "churn")


@query("join_rfm_segments", S.scored_sql("""
SELECT r.card, r.recency_days, r.frequency, s.cluster_id, s.segment_name
FROM rfm r JOIN segments s USING (card)""", S.SEGMENTS))
def _(spark, sf_dir):
    scored = inputs.scored(spark, sf_dir)
    named = inputs.segments_of(scored).select("card", "cluster_id", "segment_name")
    return scored.select("card", "recency_days", "frequency").join(named, "card")


@query("join_churn_label", S.rfm_sql("""
SELECT r.card, r.frequency, b.churn FROM rfm r JOIN beh b USING (card)""", S.behaviour()))
def _(spark, sf_dir):
    labels = customers.behaviour(inputs.sales(spark, sf_dir)).select("card", "churn")
    return inputs.rfm(spark, sf_dir).select("card", "frequency").join(labels, "card")


@query("churn_features", S.churn_sql("SELECT * FROM churnfeat"), RFM_DOUBLES + " avg_ticket_recent:7")
def _(spark, sf_dir):
    return inputs.churn_table(spark, sf_dir)
