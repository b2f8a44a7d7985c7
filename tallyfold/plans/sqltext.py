"""SQL of the logical tables, as common table expressions for the checks."""

from __future__ import annotations

DAY_US = "86400000000.0"

SALES = """txn AS (
  SELECT o_orderdate AS datetime,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'cash' ELSE 'card' END AS cash_type,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS VARCHAR) END AS card,
         l_extendedprice * (1 - l_discount) AS money,
         p_type AS coffee_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

EVENTS = """evt AS (
  SELECT ts AS datetime,
         CASE WHEN event_type = 'view' THEN 'cash' ELSE 'card' END AS cash_type,
         CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS card,
         value AS money, event_type AS coffee_name
  FROM events)"""

WHITELIST = "('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD')"

DAILY = f"""daily AS (
  SELECT coffee_name AS product, CAST(datetime AS DATE) AS date,
         sum(money) AS revenue, count(money) AS n_transactions
  FROM txn WHERE coffee_name IN {WHITELIST} GROUP BY 1, 2)"""

# Sales days of every product, and the same on each product's own calendar.
DAILY_ALL = """daily_all AS (
  SELECT coffee_name AS product, CAST(datetime AS DATE) AS date,
         sum(money) AS revenue, count(money) AS n_transactions
  FROM txn GROUP BY 1, 2)"""

OWN_GRID = """own_grid AS (
  SELECT g.product, g.date, coalesce(d.revenue, 0.0) AS revenue,
         coalesce(d.n_transactions, 0) AS n_transactions
  FROM (SELECT product, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM daily_all GROUP BY product) g
  LEFT JOIN daily_all d USING (product, date))"""

GRID = """grid AS (
  SELECT g.product, g.date, coalesce(d.revenue, 0.0) AS revenue,
         coalesce(d.n_transactions, 0) AS n_transactions
  FROM (SELECT product, CAST(unnest(generate_series(
           (SELECT min(date) FROM daily), (SELECT max(date) FROM daily), INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT DISTINCT product FROM daily)) g
  LEFT JOIN daily d USING (product, date))"""

DEMAND = """demand AS (
  SELECT product, date, revenue, n_transactions,
         coalesce(lag(revenue, 1) OVER w, 0.0) AS lag_1,
         coalesce(lag(revenue, 7) OVER w, 0.0) AS lag_7,
         coalesce(lag(revenue, 14) OVER w, 0.0) AS lag_14,
         coalesce(avg(revenue) OVER (PARTITION BY product ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_mean_7,
         coalesce(avg(revenue) OVER (PARTITION BY product ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_mean_14,
         CAST(isodow(date) - 1 AS TINYINT) AS day_of_week,
         CAST(isodow(date) >= 6 AS TINYINT) AS is_weekend,
         CAST(month(date) AS TINYINT) AS month
  FROM grid WINDOW w AS (PARTITION BY product ORDER BY date))"""


def rfm(source: str = "txn") -> str:
    return f"""cust AS (
  SELECT card, max(datetime) AS last_purchase, count(datetime) AS frequency, sum(money) AS monetary
  FROM {source} WHERE card IS NOT NULL AND card <> 'anonymous' GROUP BY card),
rec AS (
  SELECT card, frequency, monetary,
         CAST(floor((epoch_us(date_trunc('day', (SELECT max(last_purchase) FROM cust))) - epoch_us(last_purchase)) / {DAY_US}) AS BIGINT) AS recency_days
  FROM cust),
rfm AS (
  SELECT card, recency_days, frequency, monetary,
         1.0 - CASE WHEN max(recency_days) OVER () = min(recency_days) OVER () THEN 0.5
               ELSE (recency_days - min(recency_days) OVER ()) / CAST(max(recency_days) OVER () - min(recency_days) OVER () AS DOUBLE) END AS recency_norm,
         CASE WHEN max(frequency) OVER () = min(frequency) OVER () THEN 0.5
               ELSE (frequency - min(frequency) OVER ()) / CAST(max(frequency) OVER () - min(frequency) OVER () AS DOUBLE) END AS frequency_norm,
         CASE WHEN max(monetary) OVER () = min(monetary) OVER () THEN 0.5
               ELSE (monetary - min(monetary) OVER ()) / (max(monetary) OVER () - min(monetary) OVER ()) END AS monetary_norm
  FROM rec)"""


SCORED = """ranks AS (
  SELECT *, row_number() OVER (ORDER BY recency_days DESC, card) AS rr,
         row_number() OVER (ORDER BY frequency, card) AS rf,
         row_number() OVER (ORDER BY monetary, card) AS rm,
         count(*) OVER () AS n FROM rfm),
quint AS (
  SELECT * EXCLUDE (rr, rf, rm, n),
         CAST(greatest(1, ceil(5 * (rr - 1) / (n - 1))) AS INTEGER) AS r_quintile,
         CAST(greatest(1, ceil(5 * (rf - 1) / (n - 1))) AS INTEGER) AS f_quintile,
         CAST(greatest(1, ceil(5 * (rm - 1) / (n - 1))) AS INTEGER) AS m_quintile
  FROM ranks),
scored AS (
  SELECT *, r_quintile + f_quintile + m_quintile AS rfm_score,
         CASE WHEN r_quintile + f_quintile + m_quintile >= 11 THEN 'Champions'
              WHEN r_quintile + f_quintile + m_quintile >= 8 THEN 'Loyal'
              WHEN r_quintile + f_quintile + m_quintile >= 6 THEN 'Potential'
              WHEN r_quintile + f_quintile + m_quintile >= 4 THEN 'At Risk'
              ELSE 'Lost' END AS segment_name
  FROM quint)"""

# Segments as a cluster table: the position of the segment in the ladder is its id.
SEGMENTS = """segments AS (
  SELECT card, CASE segment_name WHEN 'Champions' THEN 0 WHEN 'Loyal' THEN 1
                    WHEN 'Potential' THEN 2 WHEN 'At Risk' THEN 3 ELSE 4 END AS cluster_id,
         segment_name, recency_days, frequency, monetary
  FROM scored)"""


def behaviour(window: int = 90, source: str = "txn") -> str:
    return f"""refday AS (SELECT date_trunc('day', max(datetime)) AS ref FROM {source} WHERE card IS NOT NULL),
beh AS (
  SELECT card,
         CAST(max(datetime) < any_value(ref) - INTERVAL {window} DAY AS INTEGER) AS churn,
         count(*) FILTER (datetime >= ref - INTERVAL 28 DAY) AS freq_last_4w,
         count(*) FILTER (datetime >= ref - INTERVAL 56 DAY) AS freq_last_8w,
         coalesce(avg(money) FILTER (datetime >= ref - INTERVAL 56 DAY), 0.0) AS avg_ticket_recent,
         count(DISTINCT coffee_name) AS n_distinct_products,
         CAST(floor((epoch_us(any_value(ref)) - epoch_us(min(datetime))) / {DAY_US}) AS BIGINT) AS days_since_first_purchase
  FROM {source}, refday WHERE card IS NOT NULL GROUP BY card)"""


CHURN = """churnfeat AS (
  SELECT r.*, s.cluster_id, s.segment_name, b.* EXCLUDE (card)
  FROM rfm r JOIN segments s USING (card) JOIN beh b USING (card))"""


# Hold-out of the last 30 days and the seasonal-naive forecast on it.
NAIVE = """cut AS (SELECT max(date) - 29 AS c FROM demand),
train AS (SELECT demand.* FROM demand, cut WHERE date < c),
test AS (SELECT demand.* FROM demand, cut WHERE date >= c),
same_day AS (SELECT product, day_of_week, arg_max(revenue, date) AS y FROM train GROUP BY 1, 2),
fallback AS (SELECT product, avg(revenue) AS y FROM train GROUP BY 1),
naive AS (
  SELECT test.product, test.date, test.revenue, coalesce(same_day.y, fallback.y) AS prediction
  FROM test LEFT JOIN same_day USING (product, day_of_week) LEFT JOIN fallback USING (product))"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body


def demand_sql(body: str, *more: str) -> str:
    return with_ctes(SALES, DAILY, GRID, DEMAND, *more, body=body)


def naive_sql(body: str, *more: str) -> str:
    return demand_sql(body, NAIVE, *more)


def rfm_sql(body: str, *more: str) -> str:
    return with_ctes(SALES, rfm(), *more, body=body)


def scored_sql(body: str, *more: str) -> str:
    return rfm_sql(body, SCORED, *more)


def churn_sql(body: str, *more: str) -> str:
    return scored_sql(body, SEGMENTS, behaviour(), CHURN, *more)
