"""Customer tables: recency, frequency, spend, quintile segments and churn features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import numeric, temporal
from tallyfold.operators import cleaning
from tallyfold.operators.ordering import running_totals
from tallyfold.scratch import materialise

RFM_RAW = ["recency_days", "frequency", "monetary"]
RFM_NORM = ["recency_norm", "frequency_norm", "monetary_norm"]
RFM_COLUMNS = ["card", *RFM_RAW, *RFM_NORM]

# Lowest score of each segment, best segment first.
SEGMENT_FLOORS = [(11, "Champions"), (8, "Loyal"), (6, "Potential"), (4, "At Risk"), (3, "Lost")]
QUINTILES = 5

CHURN_WINDOW_DAYS = 90
CHURN_COLUMNS = [
    *RFM_COLUMNS, "cluster_id", "segment_name", "churn", "freq_last_4w", "freq_last_8w",
    "avg_ticket_recent", "n_distinct_products", "days_since_first_purchase",
]


def minmax_columns(df: DataFrame, columns: dict[str, str], inverted: tuple[str, ...] = ()) -> DataFrame:
    """Add min-max scaled columns ``{source: target}``; ``df`` should be stored, it is read twice."""
    bounds = df.agg(
        F.struct(
            *[F.min(c).alias(f"{c}_lo") for c in columns],
            *[F.max(c).alias(f"{c}_hi") for c in columns],
        )
    ).scalar()

    def scaled(c: str) -> Column:
        rule = numeric.minmax_inverted if c in inverted else numeric.minmax
        return rule(F.col(c), bounds[f"{c}_lo"], bounds[f"{c}_hi"])

    return df.withColumns({target: scaled(c) for c, target in columns.items()})


def rfm_features(sales: DataFrame, clamp_zero: bool = False) -> DataFrame:
    """One row per known customer.

    ``recency_days`` counts from midnight of the last sales day, so it is -1 for a
    purchase later on that day; ``clamp_zero`` turns this into 0.
    """
    per_customer = (
        cleaning.identified(sales.transform(cleaning.parse_datetime))
        .groupBy("card")
        .agg(
            F.max("datetime").alias("last_purchase"),
            F.count("datetime").alias("frequency"),
            F.coalesce(F.sum("money"), F.lit(0.0)).alias("monetary"),
        )
    )
    return _rfm(materialise(per_customer, "customers"), clamp_zero)


def rfm_of_purchases(bought: DataFrame, clamp_zero: bool = False) -> DataFrame:
    """``rfm_features`` from the smaller table of ``purchases``."""
    per_customer = cleaning.identified(bought).groupBy("card").agg(
        F.max("last").cast("timestamp_ntz").alias("last_purchase"),
        F.sum("n").alias("frequency"),
        F.coalesce(F.sum("spend"), F.lit(0.0)).alias("monetary"),
    )
    return _rfm(materialise(per_customer, "customers"), clamp_zero)


def _rfm(per_customer: DataFrame, clamp_zero: bool) -> DataFrame:
    reference = temporal.day_start(per_customer.agg(F.max("last_purchase")).scalar())
    recency = temporal.floor_days(reference, F.col("last_purchase"))
    if clamp_zero:
        recency = F.greatest(recency, F.lit(0))
    return minmax_columns(
        per_customer.withColumn("recency_days", recency),
        dict(zip(RFM_RAW, RFM_NORM)),
        inverted=("recency_days",),
    ).select(*RFM_COLUMNS)


def segment_of_score(score: Column) -> Column:
    out = F.when(score >= SEGMENT_FLOORS[0][0], SEGMENT_FLOORS[0][1])
    for floor, name in SEGMENT_FLOORS[1:]:
        out = out.when(score >= floor, name)
    return out


def rfm_quintiles(rfm: DataFrame) -> DataFrame:
    """Quintiles of the unique ranks, score and named segment.

    Ranks break ties by customer key. A quintile only depends on which of four cut
    rows a customer sorts after, so the cut rows are located in a distributed order
    and every customer is compared with them; no rank is joined back.
    """
    metrics = {"r_quintile": -F.col("recency_days"), "f_quintile": F.col("frequency"),
               "m_quintile": F.col("monetary")}
    stored = materialise(rfm, "rfm")
    long = stored.select(
        "card", *[m.cast("double").alias(name) for name, m in metrics.items()]
    ).unpivot(["card"], list(metrics), "metric", "value")
    ranked = running_totals(
        long.withColumn("one", F.lit(1).cast("bigint")), ["value", "card"], ["one"], ["metric"]
    )
    steps = range(1, QUINTILES)
    cut_rank = {j: F.lit(1) + F.floor(j * (F.col("one_total") - 1) / QUINTILES) for j in steps}
    row = F.struct("value", "card")
    cuts = ranked.agg(
        F.struct(
            *[
                F.max(
                    F.when((F.col("metric") == name) & (F.col("one_upto") == cut_rank[j]), row)
                ).alias(f"{name}_{j}")
                for name in metrics
                for j in steps
            ]
        )
    ).scalar()

    def quintile(name: str, value: Column) -> Column:
        me = F.struct(value.cast("double").alias("value"), F.col("card").alias("card"))
        passed = [(me > cuts[f"{name}_{j}"]).cast("int") for j in steps]
        return sum(passed, F.lit(1))

    scored = stored.withColumns({name: quintile(name, m) for name, m in metrics.items()})
    score = F.col("r_quintile") + F.col("f_quintile") + F.col("m_quintile")
    return scored.withColumn("rfm_score", score).withColumn(
        "segment_name", segment_of_score(F.col("rfm_score"))
    )


def _days_before(reference: Column, days: int) -> Column:
    return F.timestamp_add("DAY", F.lit(-days), reference)


def purchases(sales: DataFrame, reference: Column) -> DataFrame:
    """One row per customer and product: first and last sale, number, spend, and those of the weeks before ``reference``.

    The distinct count of products then adds up rows, and a customer with a large share of all sales is combined
    before the shuffle.
    """
    carded = sales.where(F.col("card").isNotNull() & F.col("datetime").isNotNull())
    recent_4w = F.col("datetime") >= _days_before(reference, 28)
    recent_8w = F.col("datetime") >= _days_before(reference, 56)
    return carded.groupBy("card", "coffee_name").agg(
        F.max("datetime").alias("last"),
        F.min("datetime").alias("first"),
        F.count("datetime").alias("n"),
        F.sum("money").alias("spend"),
        F.count_if(recent_4w).alias("n4"),
        F.count_if(recent_8w).alias("n8"),
        F.sum(F.when(recent_8w, F.col("money"))).alias("spend8"),
        F.count(F.when(recent_8w, F.col("money"))).alias("paid8"),
    )


def stored_purchases(sales: DataFrame, latest: Column) -> DataFrame:
    """``purchases`` up to the last day of any sale with a card, stored, from one pass over ``sales``.

    ``latest`` is where that day is expected, such as the day of the last order; where no sale is found on
    it, a second pass counts from the day the first one found.
    """
    bought = materialise(purchases(sales, temporal.day_start(latest)), "purchases")
    found = temporal.day_start(bought.agg(F.max("last")).scalar())
    if bought.sparkSession.range(1).select(found.eqNullSafe(temporal.day_start(latest))).first()[0]:
        return bought
    return materialise(purchases(sales, found), "purchases")


def behaviour(sales: DataFrame, window_days: int = CHURN_WINDOW_DAYS) -> DataFrame:
    """Churn label and behavioural features per customer, from one grouping.

    The reference day is the last day of any sale with a card.
    """
    carded = sales.where(F.col("card").isNotNull() & F.col("datetime").isNotNull())
    reference = temporal.day_start(carded.agg(F.max("datetime")).scalar())
    return _behaviour(purchases(sales, reference), reference, window_days)


def behaviour_of_purchases(bought: DataFrame, window_days: int = CHURN_WINDOW_DAYS) -> DataFrame:
    """``behaviour`` from what ``stored_purchases`` returned."""
    return _behaviour(bought, temporal.day_start(bought.agg(F.max("last")).scalar()), window_days)


def _behaviour(bought: DataFrame, reference: Column, window_days: int) -> DataFrame:
    return bought.groupBy("card").agg(
        (F.max("last") < _days_before(reference, window_days)).cast("int").alias("churn"),
        F.sum("n4").alias("freq_last_4w"),
        F.sum("n8").alias("freq_last_8w"),
        F.coalesce(numeric_mean("spend8", "paid8"), F.lit(0.0)).alias("avg_ticket_recent"),
        F.count("coffee_name").alias("n_distinct_products"),
        temporal.floor_days(reference, F.min("first")).alias("days_since_first_purchase"),
    )


def numeric_mean(total: str, count: str) -> Column:
    """Mean from partial sums; NULL when nothing was counted."""
    n = F.sum(count)
    return F.when(n > 0, F.sum(total) / n)


def churn_features(sales: DataFrame, rfm: DataFrame, segments: DataFrame,
                   window_days: int = CHURN_WINDOW_DAYS) -> DataFrame:
    """Customers present in all three inputs, with label, segment and behaviour."""
    return join_churn_features(rfm, segments, behaviour(sales, window_days))


def join_churn_features(rfm: DataFrame, segments: DataFrame, behaved: DataFrame) -> DataFrame:
    return (
        rfm.select(*RFM_COLUMNS)
        .join(segments.select("card", "cluster_id", "segment_name"), "card")
        .join(behaved, "card")
        .select(*CHURN_COLUMNS)
    )
