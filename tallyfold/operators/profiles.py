"""Descriptive profiles of sales, products and customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions import numeric, temporal
from tallyfold.operators import cleaning
from tallyfold.operators.ordering import exact_quantiles, long_form
from tallyfold.scratch import materialise

# Short day names, Monday first.
SHORT_DAYS = ["Seg", "Ter", "Qua", "Qui", "Sex", "Sáb", "Dom"]


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: count, mean, sample deviation, minimum, exact quartiles, maximum."""
    stored = materialise(df.select(*columns), "describe")
    long = long_form(stored, columns, names="column").where(F.col("value").isNotNull())
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["column"]).select(
        "column", *[F.col("quantiles")[i].alias(f"p{p}") for i, p in enumerate((25, 50, 75))]
    )
    return moments.join(quartiles, "column")


def histogram(df: DataFrame, column: str, bins: int, low: float | None = None,
              high: float | None = None) -> DataFrame:
    """Equal-width counts ``bin`` 1..bins; the upper edge belongs to the last bin.

    Values outside a given range are left out; without a range the data sets it.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    if low is None or high is None:
        span = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
        lo, hi = span["lo"], span["hi"]
    else:
        lo, hi = F.lit(float(low)), F.lit(float(high))
        values = values.where(F.col("v").between(lo, hi))
    place = F.floor((F.col("v") - lo) / (hi - lo) * bins) + 1
    bin_no = F.when(lo == hi, F.lit(1)).otherwise(F.least(place, F.lit(bins))).cast("int")
    return values.groupBy(bin_no.alias("bin")).agg(F.count("*").alias("n"))


def product_stats(sales: DataFrame) -> DataFrame:
    return (
        sales.where(F.col("coffee_name").isNotNull())
        .groupBy("coffee_name")
        .agg(F.count("money").alias("volume"), F.sum("money").alias("revenue"))
        .withColumn("avg_ticket", numeric.half_even(F.col("revenue") / F.col("volume"), 2))
    )


def share_of_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their percentage, one decimal. Values must be few."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    # The window sees one row per distinct value.
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("pct", numeric.half_even(F.col("count") / total * 100, 1))


def identified_share(sales: DataFrame) -> DataFrame:
    """One row: known and anonymous sales, their shares, and distinct known customers."""
    known = F.col("card").isNotNull() & (F.col("card") != cleaning.ANONYMOUS)
    per_card = sales.groupBy(F.when(known, F.col("card")).alias("card")).agg(F.count("*").alias("n"))
    anonymous = F.coalesce(F.sum(F.when(F.col("card").isNull(), F.col("n"))), F.lit(0))
    row = per_card.agg(
        F.sum("n").alias("transactions"),
        anonymous.alias("anonymous"),
        F.count("card").alias("customers"),
    )
    identified = F.col("transactions") - F.col("anonymous")
    return row.select(
        identified.alias("identified"),
        "anonymous",
        "customers",
        numeric.as_percent(identified / F.col("transactions")).alias("identified_pct"),
        numeric.as_percent(F.col("anonymous") / F.col("transactions")).alias("anonymous_pct"),
    )


def sales_by(sales: DataFrame, **keys: Column) -> DataFrame:
    """Transactions and revenue by the given key expressions."""
    return sales.groupBy(*[c.alias(name) for name, c in keys.items()]).agg(
        F.count("money").alias("transactions"), F.sum("money").alias("revenue")
    )


def hourly_profile(sales: DataFrame) -> DataFrame:
    return sales_by(sales, hour=F.hour("datetime"))


def weekday_profile(sales: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(n) for n in SHORT_DAYS])
    return sales_by(sales, day_of_week=F.weekday("datetime")).withColumn(
        "day_name", F.element_at(names, F.col("day_of_week") + 1)
    )


def monthly_profile(sales: DataFrame) -> DataFrame:
    return sales_by(sales, year=F.year("datetime"), month=F.month("datetime")).withColumn(
        "period", temporal.month_label(F.col("year"), F.col("month"))
    )


def busiest(profile: DataFrame, key: str) -> DataFrame:
    """The key with most transactions; the smallest one on ties."""
    return profile.agg(
        F.max_by(key, F.struct(F.col("transactions"), -F.col(key))).alias(key),
        F.max("transactions").alias("transactions"),
    )


def customer_stats(sales: DataFrame) -> DataFrame:
    """Per known customer; recency counts from the day after the last sale of all."""
    last_day = sales.agg(F.max("datetime")).scalar()
    reference = F.timestamp_add("DAY", F.lit(1), temporal.day_start(last_day))
    per_card = cleaning.identified(sales).groupBy("card").agg(
        F.count("datetime").alias("frequency"),
        F.sum("money").alias("total_spend"),
        F.avg("money").alias("avg_ticket"),
        F.min("datetime").alias("first_purchase"),
        F.max("datetime").alias("last_purchase"),
    )
    return per_card.withColumns(
        {
            "recency_days": temporal.floor_days(reference, F.col("last_purchase")),
            "tenure_days": temporal.floor_days(F.col("last_purchase"), F.col("first_purchase")),
        }
    )


def customer_summary(stats: DataFrame) -> DataFrame:
    """One row over a stored ``customer_stats`` table."""
    median = exact_quantiles(stats, "recency_days", [0.5]).select(F.col("quantiles")[0]).scalar()
    return stats.agg(
        F.count("*").alias("customers"),
        F.avg("frequency").alias("mean_frequency"),
        F.avg("avg_ticket").alias("mean_ticket"),
        F.count_if(F.col("frequency") == 1).alias("one_purchase"),
        F.count_if(F.col("frequency") >= 5).alias("five_or_more"),
    ).withColumn("median_recency", median)


def purchase_days(sales: DataFrame) -> DataFrame:
    """Distinct (customer, day) pairs of known customers."""
    return cleaning.identified(sales).select("card", F.to_date("datetime").alias("day")).distinct()


def purchase_intervals(sales: DataFrame) -> DataFrame:
    """Days between consecutive purchase days of a customer.

    A customer has at most one row per calendar day here, whatever their sales.
    """
    before = F.lag("day").over(Window.partitionBy("card").orderBy("day"))
    gaps = purchase_days(sales).withColumn("ipi_days", F.datediff("day", before))
    return gaps.where(F.col("ipi_days").isNotNull())


def active_days(daily: DataFrame) -> DataFrame:
    """Per product: calendar days from first to last sale, and days with a sale."""
    return daily.groupBy("product").agg(
        (F.datediff(F.max("date"), F.min("date")) + 1).alias("n_days"),
        F.count_if(F.col("n_transactions") > 0).alias("n_active_days"),
    )


def segment_profile(rows: DataFrame, by: str, columns: Sequence[str], digits: int = 1) -> DataFrame:
    """Rows and exact medians per segment or cluster."""
    stored = materialise(
        rows.select(by, *[F.col(c).cast("double").alias(c) for c in columns]).where(F.col(by).isNotNull()),
        "profile",
    )
    medians = exact_quantiles(long_form(stored, columns, [by]), "value", [0.5], [by, "feature"])
    wide = medians.groupBy(by).agg(
        *[
            numeric.half_even(
                F.max(F.when(F.col("feature") == c, F.col("quantiles")[0])), digits
            ).alias(c)
            for c in columns
        ]
    )
    sizes = stored.groupBy(by).agg(F.count("*").alias("size"))
    return wide.join(sizes, by)


def class_distribution(rows: DataFrame, label: str = "churn") -> DataFrame:
    """One row: both class counts, their shares, and negatives per positive."""
    row = rows.agg(
        F.count_if(F.col(label) == 0).alias("n_neg"), F.count_if(F.col(label) == 1).alias("n_pos")
    )
    total = F.col("n_neg") + F.col("n_pos")
    return row.select(
        "*",
        (F.col("n_neg") / total).alias("neg_share"),
        (F.col("n_pos") / total).alias("pos_share"),
        F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos")).alias("neg_per_pos"),
    )


def class_means(rows: DataFrame, columns: Sequence[str], label: str = "churn") -> DataFrame:
    """Mean of each feature per class, and the difference in % of the negative class."""
    value = F.col("value")
    means = long_form(rows, columns, [label]).groupBy("feature").agg(
        F.avg(F.when(F.col(label) == 0, value)).alias("active_mean"),
        F.avg(F.when(F.col(label) == 1, value)).alias("churned_mean"),
    )
    change = (F.col("active_mean") - F.col("churned_mean")) / F.nullif("active_mean", F.lit(0.0))
    return means.withColumn("diff_pct", numeric.half_even(change * 100, 1))


def correlation_matrix(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, as one row per first column."""
    pairs = {(a, b): f"c_{i}_{j}" for i, a in enumerate(columns) for j, b in enumerate(columns)}
    row = rows.agg(*[F.corr(a, b).alias(name) for (a, b), name in pairs.items()])
    lines = F.array(
        *[
            F.struct(F.lit(a).alias("feature"), *[F.col(pairs[a, b]).alias(b) for b in columns])
            for a in columns
        ]
    )
    return row.select(F.inline(lines))


def revenue_by_product(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.col("coffee_name").alias("product")).agg(
        F.sum("money").alias("revenue")
    ).orderBy(F.col("revenue").desc(), "product")


def kpi_totals(sales: DataFrame) -> DataFrame:
    """Revenue, mean ticket (0 without sales), transactions and distinct products."""
    per_product = sales.groupBy("coffee_name").agg(
        F.sum("money").alias("revenue"), F.count("money").alias("paid"), F.count("*").alias("n")
    )
    row = per_product.agg(
        F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("revenue"),
        F.coalesce(F.sum("paid"), F.lit(0)).alias("_paid"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("transactions"),
        F.count("coffee_name").alias("products"),
    )
    return row.select(
        "revenue",
        numeric.safe_ratio(F.col("revenue"), F.col("_paid")).alias("avg_ticket"),
        "transactions",
        "products",
    )


def daily_average_revenue(sales: DataFrame) -> DataFrame:
    daily = sales.groupBy(F.to_date("datetime").alias("date")).agg(F.sum("money").alias("revenue"))
    return daily.agg(F.avg("revenue").alias("daily_avg_revenue"))


def top_and_bottom(df: DataFrame, measure: str, key: str, n: int = 5) -> DataFrame:
    """The ``n`` largest and ``n`` smallest rows, marked by ``side``; both sides may overlap."""
    top = df.orderBy(F.col(measure).desc(), key).limit(n).withColumn("side", F.lit("top"))
    bottom = df.orderBy(F.col(measure), F.col(key).desc()).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def top_n(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), key).limit(n)


def append_average(df: DataFrame, key: str, measures: Sequence[str], label: str = "AVERAGE") -> DataFrame:
    """The rows plus one that averages every measure; NaN and NULL do not count."""
    clean = df.select(key, *[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) for c in measures])
    mean = clean.agg(*[F.avg(c).alias(c) for c in measures]).withColumn(key, F.lit(label))
    return clean.unionByName(mean)
